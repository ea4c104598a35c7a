"""Zone rosters arriving over time, applied in order with foreachBatch."""
