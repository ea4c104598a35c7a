"""The hand-derived golden fixture (userbase 12 rows, roster 10, add list 5)."""

from rollcall import schema as S

UB_COLS = [S.ZONE, S.GLOBAL_ID, S.LOCAL_ID, S.NAME, S.EMAIL, S.STATUS, S.ORD]
USERBASE = [
    ("EUR", "100", "EUR-1", "Ann", "ann@x.com", "", 0),
    ("EUR", "101.0", "EUR-2", "Bob", "bob@x.com", "", 1),
    ("eur", "102", "EUR-3", "Cid", "cid@x.com", "", 2),
    ("EUR", "103", "EUR-4", "Dee", "dee@x.com", "validated", 3),
    ("EUR", "104", "EUR-5", "Eve", "eve@x.com", "", 4),
    ("APAC", "105", "AP-1", "Fay", "fay@y.com", "", 5),
    ("APAC", "106", "AP-2", "Gus", "gus@y.com", "", 6),
    ("EUR", "107", "EUR-8", "Hal", "hal@x.com", "", 7),
    ("EUR", "108", "EUR-9", "Ivy", "ANN@x.com", "", 8),
    ("EUR", "109", "", "Jon", "", "", 9),
    ("APAC", "110", "", "Kim", "", "", 10),
    ("EUR", "00111", "EUR-12", "Lee", "lee@x.com", "", 11),
]
ROSTER_COLS = [S.GLOBAL_ID, S.LOCAL_ID, S.NAME, S.EMAIL, "Action", S.ORD]
ROSTER = [
    ("", "", "", " mailto:Ann@X.com ", "ok", 0),
    ("101", "", "", "robert@x.com", "remove from list", 1),
    ("", " eur-3 ", "", "cid@new.com", " OK ", 2),
    ("", "", "", "dee@x.com", "", 3),
    ("104", "", "", "fay@y.com", "ok", 4),
    ("", "", "", "hal@x.com", "ok", 5),
    ("107", "", "", "h@x.com", "Left", 6),
    ("111", "", "Lee", "lee@z.com", "ok", 7),
    ("106", "", "", "noemail@x.com", "ok", 8),
    ("105", "", "", "", "remove from list", 9),
]
ADD_COLS = [S.ZONE, S.GLOBAL_ID, S.LOCAL_ID, S.NAME, S.EMAIL, S.ORD]
ADD = [
    ("", "201.0", "EUR-20", "N1", "new1@x.com", 0),
    ("EUR", "202", "EUR-21", "N1b", "NEW1@x.com", 1),
    ("EUR", "999", "", "Bob", "bob@x.com", 2),
    ("APAC", "203", "", "N2", "new2@y.com", 3),
    ("EUR", "204", "", "N3", "noat", 4),
]


def frames(spark):
    def df(rows, cols):
        schema = ", ".join(f"`{c}` {'bigint' if c == S.ORD else 'string'}" for c in cols)
        return spark.createDataFrame(rows, schema)

    return df(USERBASE, UB_COLS), df(ROSTER, ROSTER_COLS), df(ADD, ADD_COLS)
