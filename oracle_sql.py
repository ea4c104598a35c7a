"""DuckDB oracle texts, one per registered query.

Written independently of the Spark plans: the cascade is a CASE over
``IN (subquery)`` tests, hits are a UNION ALL of three equi-joins, the
dedupe is ``QUALIFY row_number()``. Normalisation is spelled for the ASCII
data the derivation produces (DuckDB has no NFKC and its ``trim`` removes
spaces only); Unicode cases are covered by the scalar golden tests.
Column names are the short aliases the Spark queries return.
"""

from __future__ import annotations

ZONE = "AMERICA"
ZONE2 = "EUROPE"


def v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def strip(x: str) -> str:
    return f"trim(coalesce({x}, ''))"


def n_email(x: str) -> str:
    s1 = f"lower(trim(coalesce({x}, '')))"
    s2 = f"(CASE WHEN starts_with({s1}, 'mailto:') THEN substr({s1}, 8) ELSE {s1} END)"
    s3 = f"trim(trim(trim({s2}), '\"''<>'))"
    return f"regexp_replace({s3}, '\\s', '', 'g')"


def n_id(x: str) -> str:
    return f"regexp_replace(trim(coalesce({x}, '')), '^([0-9]+)\\.0$', '\\1')"


def n_local(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


def valid(x: str) -> str:
    return f"(coalesce({x}, '') LIKE '%@%' AND lower(coalesce({x}, '')) NOT LIKE '%noemail@%')"


def act(x: str) -> str:
    return (
        f"(CASE WHEN lower(trim(coalesce({x}, ''))) = 'ok' THEN 'validate' "
        f"WHEN trim(coalesce({x}, '')) = '' THEN 'noop' ELSE 'remove' END)"
    )


UB_COLS = ["zone", "country", "gid", "lid", "name", "email", "status"]
CLEAN_COLS = ["zone", "country", "gid", "lid", "name", "emp_status", "email"]

_GID = (
    "CASE WHEN c_custkey % 5 = 0 THEN concat(CAST(c_custkey AS VARCHAR), '.0') "
    "WHEN c_custkey % 11 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') "
    "ELSE CAST(c_custkey AS VARCHAR) END"
)
_EMAIL = (
    "CASE WHEN c_custkey % 50 = 7 THEN '' "
    "WHEN c_custkey % 50 = 9 THEN 'noemail@corp.com' "
    "WHEN c_custkey % 50 = 11 THEN 'no-at-sign' "
    "WHEN c_custkey % 40 = 3 THEN concat('USER', CAST(c_custkey - 1 AS VARCHAR), '@Corp.com') "
    "ELSE concat('user', CAST(c_custkey AS VARCHAR), '@corp.com') END"
)
_PEOPLE = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"

_NAME = (
    "CASE c_custkey % 17 WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN concat('Smith, \"', c_name, '\", Jr') "
    "WHEN 4 THEN concat(' ', c_name, ' ') WHEN 5 THEN concat(c_name, chr(10), 'II') ELSE c_name END"
)

UB = f"""ub AS (
  SELECT r_name AS zone, n_name AS country, {_GID} AS gid, concat('L-', CAST(c_custkey AS VARCHAR)) AS lid,
         {_NAME} AS name, {_EMAIL} AS email, '' AS status, 0 AS gen, c_custkey AS ord
  FROM {_PEOPLE})"""

EXPORT = f"""ex AS (
  SELECT r_name AS zone, n_name AS country, {_GID} AS gid, concat('L-', CAST(c_custkey AS VARCHAR)) AS lid,
         {_NAME} AS name, CASE WHEN c_custkey % 7 = 0 THEN 'Inactive' ELSE 'Active' END AS emp_status,
         {_EMAIL} AS email, 0 AS gen, c_custkey AS ord
  FROM {_PEOPLE})"""

ROSTER = f"""ros AS (
  SELECT CASE WHEN c_custkey % 17 <> 6 THEN {_NAME} END AS name,
         CASE WHEN c_custkey % 4 = 1 THEN concat('moved', CAST(c_custkey AS VARCHAR), '@new.com')
              WHEN c_custkey % 40 = 2 THEN 'noemail@corp.com'
              ELSE concat(' mailto:User', CAST(c_custkey AS VARCHAR), '@Corp.com ') END AS email,
         CASE WHEN c_custkey % 8 = 1 THEN concat('X', CAST(c_custkey AS VARCHAR)) ELSE CAST(c_custkey AS VARCHAR) END AS gid,
         CASE WHEN c_custkey % 16 = 1 THEN '' ELSE concat(' l-', CAST(c_custkey AS VARCHAR)) END AS lid,
         CASE c_custkey % 10 WHEN 6 THEN 'remove from list' WHEN 7 THEN '' WHEN 3 THEN 'Left'
              WHEN 9 THEN ' OK ' ELSE 'ok' END AS action,
         c_custkey AS ord
  FROM customer WHERE c_custkey % 3 <> 2)"""

# Queries that look at roster rows alone take all customers.
EVERYONE = ROSTER.replace(" WHERE c_custkey % 3 <> 2", "")

ROSTER2 = """ros2 AS (
  SELECT c_name AS name,
         CASE WHEN c_custkey % 6 = 5 THEN concat('User', CAST(c_custkey AS VARCHAR), '@corp.com')
              ELSE concat('other', CAST(c_custkey AS VARCHAR), '@corp.com') END AS email,
         CAST(c_custkey AS VARCHAR) AS gid,
         CASE c_custkey % 4 WHEN 0 THEN 'remove' WHEN 1 THEN '' ELSE 'ok' END AS action,
         c_custkey AS ord
  FROM customer WHERE c_custkey % 3 = 2)"""

ADD = """addl AS (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'ASIA' END AS zone,
         concat(CAST(s_suppkey + 90000000 AS VARCHAR), '.0') AS gid,
         concat('N-', CAST(s_suppkey AS VARCHAR)) AS lid, s_name AS name,
         CASE WHEN s_suppkey % 4 = 0 THEN concat('user', CAST(s_suppkey AS VARCHAR), '@corp.com')
              WHEN s_suppkey % 10 = 3 THEN 'bad'
              WHEN s_suppkey % 10 = 7 THEN concat('NEW', CAST(s_suppkey - 2 AS VARCHAR), '@corp.com')
              ELSE concat('new', CAST(s_suppkey AS VARCHAR), '@corp.com') END AS email,
         s_suppkey AS ord
  FROM supplier)"""

CLEANED = f"""cub AS (
  SELECT {', '.join(CLEAN_COLS)}, '' AS status, gen, ord FROM ex WHERE {valid('email')})"""


def reconcile_ctes(p, ub, ros, add, zone, gen, cols, add_cols=("zone", "gid", "lid", "name", "email"), has_lid=True):
    """CTEs ``{p}dec`` (rows with decisions), ``{p}pre`` (before dedupe),
    ``{p}fin`` (result) and ``{p}sum`` (counters)."""
    z = zone.strip().lower()
    lid = n_local("lid") if has_lid else "''"
    out = [
        f"{p}u AS (SELECT *, {n_email('email')} AS e, {n_id('gid')} AS g, {n_local('lid')} AS l FROM {ub})",
        f"{p}r AS (SELECT ord AS rid, {act('action')} AS act, {n_email('email')} AS e, {n_id('gid')} AS g, "
        f"{lid} AS l FROM {ros} WHERE {valid('email')})",
        f"""{p}rw AS (SELECT rid, act, e, g, l,
      CASE WHEN e <> '' AND e IN (SELECT e FROM {p}u) THEN 1
           WHEN g <> '' AND g IN (SELECT g FROM {p}u) THEN 2
           WHEN l <> '' AND l IN (SELECT l FROM {p}u) THEN 3 END AS tier FROM {p}r)""",
        f"""{p}hit AS (
      SELECT u.gen, u.ord, w.act FROM {p}u u JOIN {p}rw w ON w.tier = 1 AND u.e = w.e
      UNION ALL SELECT u.gen, u.ord, w.act FROM {p}u u JOIN {p}rw w ON w.tier = 2 AND u.g = w.g
      UNION ALL SELECT u.gen, u.ord, w.act FROM {p}u u JOIN {p}rw w ON w.tier = 3 AND u.l = w.l)""",
        f"""{p}fl AS (SELECT gen, ord, bool_or(act = 'validate') AS v, bool_or(act = 'remove') AS d
      FROM {p}hit GROUP BY gen, ord)""",
        f"""{p}dec AS (SELECT u.*, f.ord IS NOT NULL AS ref, coalesce(f.d, false) AS del,
      coalesce(f.v, false) AND NOT coalesce(f.d, false) AS val,
      lower(trim(coalesce(u.zone, ''))) = '{z}' AND f.ord IS NULL AS nf
      FROM {p}u u LEFT JOIN {p}fl f ON u.gen = f.gen AND u.ord = f.ord)""",
    ]
    status = "CASE WHEN val THEN 'validated' WHEN nf THEN 'not found in zone' ELSE status END AS status"
    kept = ", ".join(status if c == "status" else c for c in cols)
    if add:
        aligned = []
        for c in cols:
            if c == "gid":
                aligned.append(f"{n_id('gid')} AS gid")
            elif c == "zone":
                aligned.append(f"CASE WHEN trim(coalesce(zone, '')) = '' THEN '{zone}' ELSE zone END AS zone")
            elif c == "status":
                aligned.append("'newly added' AS status")
            elif c in add_cols:
                aligned.append(c)
            else:
                aligned.append(f"'' AS {c}")
        out += [
            f"{p}a AS (SELECT *, {n_email('email')} AS e, {n_id('gid')} AS g, {n_local('lid')} AS l "
            f"FROM {add} WHERE {valid('email')})",
            f"""{p}am AS (SELECT *, (e <> '' AND e IN (SELECT e FROM {p}u)) OR (g <> '' AND g IN (SELECT g FROM {p}u))
      OR (l <> '' AND l IN (SELECT l FROM {p}u)) AS matched FROM {p}a)""",
            f"{p}app AS (SELECT {', '.join(aligned)}, {gen} AS gen, ord FROM {p}am WHERE NOT matched)",
            f"{p}pre AS (SELECT {kept}, gen, ord FROM {p}dec WHERE NOT del UNION ALL SELECT * FROM {p}app)",
        ]
    else:
        out.append(f"{p}pre AS (SELECT {kept}, gen, ord FROM {p}dec WHERE NOT del)")
    em = n_email("email")
    out.append(
        f"{p}fin AS (SELECT * FROM {p}pre QUALIFY {em} = '' "
        f"OR row_number() OVER (PARTITION BY {em} ORDER BY gen, ord) = 1)"
    )
    add_counts = (
        f"(SELECT count(*) FROM {p}app) AS newly_added, "
        f"(SELECT count(*) FROM {p}am WHERE matched) AS skipped_existing, "
        if add
        else "CAST(0 AS BIGINT) AS newly_added, CAST(0 AS BIGINT) AS skipped_existing, "
    )
    bad_add = f"(SELECT count(*) FROM {add} WHERE NOT {valid('email')})" if add else "CAST(0 AS BIGINT)"
    out.append(
        f"""{p}sum AS (SELECT '{zone}' AS zone,
      (SELECT count(*) FROM {p}dec WHERE val) AS validated,
      (SELECT count(*) FROM {p}dec WHERE nf) AS not_found,
      (SELECT count(*) FROM {p}dec WHERE del) AS removed,
      {add_counts}
      (SELECT count(*) FROM {p}pre) - (SELECT count(*) FROM {p}fin) AS dedupe_removed,
      (SELECT count(*) FROM {ros} WHERE NOT {valid('email')}) AS bad_roster_emails,
      {bad_add} AS bad_add_emails,
      (SELECT count(*) FROM {p}r WHERE act = 'noop') AS blank_actions)"""
    )
    return out


def with_(*ctes) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RECONCILE = reconcile_ctes("z_", "ub", "ros", "addl", ZONE, 1, UB_COLS)
BASE = [UB, ROSTER, ADD] + RECONCILE
FINAL_COLS = "zone, country, gid, lid, name, email, status, gen, ord"


ROSTER_NM = """rosnm AS (
  SELECT name,
         CASE WHEN ord % 32 = 1 THEN concat('user', CAST(ord AS VARCHAR), '@new.org') ELSE email END AS email,
         CASE WHEN ord % 48 = 33 THEN concat('000', CAST(ord AS VARCHAR)) ELSE gid END AS gid,
         lid, action, ord
  FROM ros)"""


def _diagnose_ctes() -> list[str]:
    """Unmatched roster rows (no email filter) and the three clue lists."""
    return [
        UB,
        ROSTER,
        ROSTER_NM,
        f"du AS (SELECT *, {n_email('email')} AS e, {n_id('gid')} AS g, {n_local('lid')} AS l FROM ub)",
        f"dr AS (SELECT *, {n_email('email')} AS e, {n_id('gid')} AS g, {n_local('lid')} AS l FROM rosnm)",
        """un AS (SELECT * FROM dr WHERE NOT (
              (e <> '' AND e IN (SELECT e FROM du)) OR (g <> '' AND g IN (SELECT g FROM du))
              OR (l <> '' AND l IN (SELECT l FROM du))))""",
        """ce AS (SELECT un.ord AS rid, c.e AS candidate,
              CAST(row_number() OVER (PARTITION BY un.ord ORDER BY c.e) AS INTEGER) AS rank
            FROM un JOIN (SELECT DISTINCT e FROM du WHERE e <> '') c
              ON split_part(c.e, '@', 1) = split_part(un.e, '@', 1)
            WHERE un.e <> '' QUALIFY rank <= 3)""",
        """cg AS (SELECT un.ord AS rid, c.g AS candidate,
              CAST(row_number() OVER (PARTITION BY un.ord ORDER BY c.g) AS INTEGER) AS rank
            FROM un JOIN (SELECT DISTINCT g FROM du WHERE g <> '') c
              ON ltrim(c.g, '0') = ltrim(un.g, '0')
            WHERE un.g <> '' QUALIFY rank <= 3)""",
        """cn AS (SELECT un.ord AS rid, u.gen, u.ord, u.email, u.gid, u.lid,
              CAST(row_number() OVER (PARTITION BY un.ord ORDER BY u.gen, u.ord) AS INTEGER) AS rank
            FROM un JOIN ub u ON lower(trim(u.name)) = lower(trim(un.name))
            WHERE trim(coalesce(un.name, '')) <> '' QUALIFY rank <= 2)""",
    ]


DIAG = _diagnose_ctes()

ZONE_ROSTERS = """zr AS (
  SELECT concat('zones-', lower(replace(r_name, ' ', '_'))) AS workbook,
         CASE WHEN c_custkey % 7 = 0 THEN ' '
              WHEN r_name = 'MIDDLE EAST' AND c_custkey % 13 = 0 THEN 'EUROPE'
              ELSE concat(' ', r_name) END AS zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _norm_rows(fn) -> str:
    parts = [
        f"SELECT 'userbase' AS src, ord, {{c}} AS raw, {fn('{c}')} AS norm FROM ub",
        f"SELECT 'roster' AS src, ord, {{c}} AS raw, {fn('{c}')} AS norm FROM ros",
        f"SELECT 'add' AS src, ord, {{c}} AS raw, {fn('{c}')} AS norm FROM addl",
    ]
    return " UNION ALL ".join(parts)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    ubsel = "SELECT zone, country, gid, lid, name, email, status FROM ub"
    q["read_userbase"] = with_(UB) + ubsel
    clean_sel = f"SELECT {', '.join(CLEAN_COLS)} FROM ex WHERE {valid('email')}"
    q["read_export"] = with_(EXPORT) + clean_sel
    q["read_tabs"] = (
        with_(EVERYONE, ADD)
        + "SELECT 'Current users' AS tab, ord, gid, email FROM ros UNION ALL SELECT 'to ADD' AS tab, ord, gid, email FROM addl"
    )
    q["read_export_sheet"] = with_(EXPORT) + clean_sel
    q["write_snapshot"] = with_(*BASE) + f"SELECT {FINAL_COLS} FROM z_fin"
    q["retain_previous"] = with_(UB) + "SELECT zone, country, gid, lid, name, email, status, gen, ord FROM ub"
    q["project_required"] = with_(EXPORT) + f"SELECT {', '.join(CLEAN_COLS)}, gen, ord FROM ex"
    q["clean_export"] = with_(EXPORT) + f"SELECT {', '.join(CLEAN_COLS)}, gen, ord FROM ex WHERE {valid('email')}"
    q["valid_email"] = with_(UB, ROSTER, ADD) + " UNION ALL ".join(
        f"SELECT '{s}' AS src, ord, email, {valid('email')} AS valid FROM {t}"
        for s, t in (("userbase", "ub"), ("roster", "ros"), ("add", "addl"))
    )
    q["invalid_rows"] = with_(EVERYONE, ADD) + " UNION ALL ".join(
        f"SELECT '{s}' AS src, ord, email FROM {t} WHERE NOT {valid('email')}" for s, t in (("roster", "ros"), ("add", "addl"))
    )
    q["action_class"] = with_(EVERYONE) + f"SELECT ord, action, {act('action')} AS action_class FROM ros"
    q["in_zone"] = with_(UB) + f"SELECT ord, zone, lower(trim(zone)) = '{ZONE.lower()}' AS in_zone FROM ub"
    q["norm_id"] = with_(UB, ROSTER, ADD) + _norm_rows(n_id).format(c="gid")
    q["norm_email"] = with_(UB, ROSTER, ADD) + _norm_rows(n_email).format(c="email")
    q["norm_local"] = with_(UB, ROSTER, ADD) + _norm_rows(n_local).format(c="lid")
    q["strip"] = with_(EVERYONE) + " UNION ALL ".join(
        f"SELECT '{c}' AS col, ord, {c} AS raw, {strip(c)} AS stripped FROM ros" for c in ("email", "lid", "action")
    )
    q["email_local_part"] = with_(UB) + (
        f"SELECT ord, e AS email_norm, split_part(e, '@', 1) AS local_part "
        f"FROM (SELECT ord, {n_email('email')} AS e FROM ub) WHERE e <> ''"
    )
    q["strip_leading_zeros"] = with_(UB) + (
        f"SELECT ord, g AS gid_norm, ltrim(g, '0') AS gid_nozeros FROM (SELECT ord, {n_id('gid')} AS g FROM ub)"
    )
    q["fold_name"] = with_(EVERYONE) + "SELECT ord, name, lower(trim(coalesce(name, ''))) AS folded FROM ros"
    q["key_index"] = with_(UB) + " UNION ALL ".join(
        f"SELECT gen, ord, {t} AS tier, k AS key FROM (SELECT gen, ord, {fn} AS k FROM ub) WHERE k <> ''"
        for t, fn in ((1, n_email("email")), (2, n_id("gid")), (3, n_local("lid")))
    )
    q["cascade_match"] = with_(*BASE) + (
        "SELECT rid, act, tier, CASE tier WHEN 1 THEN e WHEN 2 THEN g ELSE l END AS key FROM z_rw WHERE tier IS NOT NULL"
    )
    q["roster_match"] = with_(*BASE) + (
        """SELECT w.rid, w.tier, w.key, count(*) AS n_hits FROM
           (SELECT rid, tier, CASE tier WHEN 1 THEN e WHEN 2 THEN g ELSE l END AS key FROM z_rw WHERE tier IS NOT NULL) w
           JOIN z_u u ON (w.tier = 1 AND u.e = w.key) OR (w.tier = 2 AND u.g = w.key) OR (w.tier = 3 AND u.l = w.key)
           GROUP BY w.rid, w.tier, w.key"""
    )
    q["add_new_only"] = with_(*BASE) + "SELECT ord, gid, email FROM z_am WHERE NOT matched"
    q["add_existing"] = with_(*BASE) + "SELECT ord, gid, email FROM z_am WHERE matched"
    q["unmatched_roster"] = with_(*DIAG) + "SELECT ord AS rid, email, gid, lid, e, g, l FROM un"
    q["nearmiss_email"] = with_(*DIAG) + "SELECT rid, rank, candidate FROM ce"
    q["nearmiss_gid"] = with_(*DIAG) + "SELECT rid, rank, candidate FROM cg"
    q["nearmiss_name"] = with_(*DIAG) + "SELECT rid, rank, gen, ord, email, gid, lid FROM cn"
    q["resolve_zone"] = with_(ZONE_ROSTERS) + (
        """SELECT workbook, CASE WHEN count(DISTINCT z) = 1 THEN min(z) END AS zone, count(DISTINCT z) AS n_zones
           FROM (SELECT workbook, CASE WHEN trim(zone) <> '' THEN trim(zone) END AS z FROM zr) GROUP BY workbook"""
    )
    q["row_flags"] = with_(*BASE) + "SELECT gen, ord, v, d FROM z_fl"
    q["reconcile_summary"] = with_(*BASE) + "SELECT * FROM z_sum"
    q["diagnose_summary"] = with_(*DIAG, ADD) + (
        f"""SELECT (SELECT count(*) FROM ub) AS userbase_rows, (SELECT count(*) FROM rosnm) AS roster_rows,
           (SELECT count(*) FROM addl) AS add_rows,
           (SELECT count(*) FROM rosnm WHERE NOT {valid('email')}) AS invalid_roster_emails,
           (SELECT count(*) FROM un) AS unmatched"""
    )
    q["removal_wins"] = with_(*BASE) + "SELECT gen, ord, val AS validated, del AS removed FROM z_dec WHERE ref"
    q["not_found"] = with_(*BASE) + "SELECT gen, ord, zone FROM z_dec WHERE nf"
    q["apply_status"] = with_(*BASE) + (
        "SELECT gen, ord, CASE WHEN val THEN 'validated' WHEN nf THEN 'not found in zone' ELSE status END AS status FROM z_dec"
    )
    q["remove_rows"] = with_(*BASE) + "SELECT gen, ord, email FROM z_dec WHERE NOT del"
    q["append_new"] = with_(*BASE) + f"SELECT {FINAL_COLS} FROM z_app"
    q["dedupe_email"] = with_(UB) + (
        f"SELECT gen, ord, email FROM ub QUALIFY {n_email('email')} = '' "
        f"OR row_number() OVER (PARTITION BY {n_email('email')} ORDER BY gen, ord) = 1"
    )
    q["topk_per_key"] = with_(UB) + (
        f"""SELECT key, rank, value FROM (
              SELECT ltrim(g, '0') AS key, g AS value,
                     CAST(row_number() OVER (PARTITION BY ltrim(g, '0') ORDER BY g) AS INTEGER) AS rank
              FROM (SELECT DISTINCT {n_id('gid')} AS g FROM ub) WHERE g <> '') WHERE rank <= 3"""
    )
    q["stable_order"] = with_(*BASE) + "SELECT row_number() OVER (ORDER BY gen, ord) - 1 AS position, gen, ord, email, status FROM z_fin"
    q["reconcile_zone"] = with_(*BASE) + f"SELECT {FINAL_COLS} FROM z_fin"
    run_cols = CLEAN_COLS + ["status"]
    q["run_zone"] = with_(EXPORT, CLEANED, ROSTER, ADD, *reconcile_ctes("z_", "cub", "ros", "addl", ZONE, 1, run_cols)) + (
        f"SELECT {', '.join(run_cols)}, gen, ord FROM z_fin"
    )
    q["nearmiss_report"] = with_(*DIAG) + (
        """SELECT rid, kind, rank, detail FROM (
             SELECT rid, 'email_domain' AS kind, rank, candidate AS detail FROM ce
             UNION ALL SELECT rid, 'gid_zeros', rank, candidate FROM cg
             UNION ALL SELECT rid, 'name', rank, concat(CAST(gen AS VARCHAR), ':', CAST(ord AS VARCHAR), '|', email, '|', gid, '|', lid) FROM cn
             UNION ALL SELECT ord, 'none', CAST(1 AS INTEGER), '' FROM un
               WHERE ord NOT IN (SELECT rid FROM ce UNION ALL SELECT rid FROM cg UNION ALL SELECT rid FROM cn))"""
    )
    step2 = reconcile_ctes("y_", "z_fin", "ros2", None, ZONE2, 2, UB_COLS, has_lid=False)
    q["accumulate_zones"] = with_(*BASE, ROSTER2, *step2) + f"SELECT {FINAL_COLS} FROM y_fin"
    return q
