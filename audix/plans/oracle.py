"""SQL twins of the query catalogue, for DuckDB over the driver's tables
(lineitem, orders, part, customer are views). Written from the semantics,
independently of the Spark code, so a match is evidence of correctness."""

from __future__ import annotations

from audix import contracts as C
from audix.plans import specs as S

FILL = C.SEGMENT_FILL_LABEL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


BASE = [
    ("txn", """
SELECT o.o_custkey AS household_id, CASE WHEN o.o_custkey % 13 <> 0 THEN o.o_custkey END AS customer_id, o.o_orderkey AS transaction_uid,
       l.l_partkey AS upc_id, CAST(o.o_orderdate AS DATE) AS date_id,
       isoyear(CAST(o.o_orderdate AS DATE)) * 100 + week(CAST(o.o_orderdate AS DATE)) AS week_id,
       year(CAST(o.o_orderdate AS DATE)) * 100 + month(CAST(o.o_orderdate AS DATE)) AS period_id,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l.l_discount * 100) AS BIGINT)) AS net_spend_amt,
       l.l_quantity AS pkg_weight_unit,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'delivery' WHEN '2-HIGH' THEN 'pickup' ELSE 'store' END AS channel
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    ("snap", "SELECT * FROM txn WHERE customer_id IS NOT NULL"),
    ("date_dim", """
SELECT d AS date_id, isoyear(d) * 100 + week(d) AS week_id, year(d) * 100 + month(d) AS period_id
FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""),
    ("seg_history", """
SELECT household_id, period_id, CASE (household_id + period_id) % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING'
       WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS seg_desc
FROM (SELECT c_custkey AS household_id, year(m) * 100 + month(m) AS period_id
      FROM customer JOIN (SELECT unnest([x, x - INTERVAL 1 MONTH, x - INTERVAL 2 MONTH]) AS m
                          FROM (SELECT date_trunc('month', CAST(max(o_orderdate) AS DATE)) - INTERVAL 2 MONTH AS x FROM orders))
        ON c_custkey % 7 <> 0)"""),
    ("prod_dim", """
SELECT p_partkey AS upc_id, p_type AS department_name, p_brand AS section_name, p_size AS class_code,
       'class_' || CAST(p_size AS VARCHAR) AS class_name FROM part"""),
    ("ncust", "SELECT count(*) AS n FROM customer"),
    ("quota", "SELECT (24 * n) // 1500 AS drink, (36 * n) // 1500 AS super FROM ncust"),
    ("pool_groups", """
SELECT p_partkey AS upc_id, p_brand AS gr_nm FROM part
WHERE p_type = 'ECONOMY' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')"""),
    ("wf_groups", """
SELECT DISTINCT upc_id, gr_nm FROM (
  SELECT p_partkey AS upc_id, l.gr_nm FROM part JOIN (VALUES
    ('PROMO', 'Brand#5', 'tea'), ('PROMO', 'Brand#6', 'coffee'), ('PROMO', 'Brand#7', 'cocoa'), ('PROMO', 'Brand#8', 'juice'),
    ('PROMO', 'Brand#9', 'soda'), ('STANDARD', 'Brand#1', 'snacks'), ('STANDARD', 'Brand#3', 'snacks'),
    ('ECONOMY', 'Brand#5', 'bakery')) l(t, b, gr_nm) ON p_type = l.t AND p_brand = l.b
  UNION ALL SELECT upc_id, 'shelf_promo' FROM prod_dim WHERE department_name = 'PROMO'
  UNION ALL SELECT upc_id, 'shelf_medium' FROM prod_dim WHERE department_name = 'MEDIUM' AND section_name < 'Brand#3'
  UNION ALL SELECT upc_id, 'shelf_large' FROM prod_dim WHERE department_name IN ('LARGE', 'PROMO') AND class_code % 3 = 0)"""),
    ("cls", """
SELECT DISTINCT upc_id FROM prod_dim
WHERE class_code IN (SELECT class_code FROM prod_dim WHERE department_name IN ('SMALL', 'MEDIUM') AND class_code <= 5)"""),
]


def _with(extra: list[tuple[str, str]], body: str, materialized: set[str] = frozenset()) -> str:
    parts = []
    for name, sql in BASE + extra:
        kw = " AS MATERIALIZED " if name in materialized else " AS "
        parts.append(f"{name}{kw}({sql.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def _segments(week_sql: str, name: str = "seg") -> list[tuple[str, str]]:
    return [
        (f"{name}_end", f"SELECT max(date_id) AS d FROM date_dim WHERE week_id = ({week_sql})"),
        (f"{name}_pick", f"""
SELECT least(coalesce((SELECT max(period_id) FROM seg_history
                       WHERE period_id >= (SELECT period_id FROM date_dim WHERE date_id = (SELECT d FROM {name}_end) - 180)),
                      (SELECT period_id FROM date_dim WHERE date_id = (SELECT d FROM {name}_end))),
             (SELECT period_id FROM date_dim WHERE date_id = (SELECT d FROM {name}_end))) AS p"""),
        (name, f"SELECT DISTINCT household_id, seg_desc FROM seg_history WHERE period_id = (SELECT p FROM {name}_pick)"),
    ]


LAST_WEEK = "SELECT max(week_id) FROM date_dim"


def _rank(source: str, groups: str, label: str | None = None, where: str = "") -> str:
    """Sales per (household, group) and row_number by sales desc, household."""
    grp = _q(label) if label else "gr_nm"
    cond = f"WHERE {where}" if where else ""
    return f"""
SELECT household_id, gr_nm, sales,
       row_number() OVER (PARTITION BY gr_nm ORDER BY sales DESC, household_id) AS gr_sales_rank
FROM (SELECT household_id, {grp} AS gr_nm, sum(net_spend_amt) AS sales
      FROM {source} JOIN {groups} USING (upc_id) {cond} GROUP BY 1, 2)"""


def _limit(source: str, limit_sql: str, by: str = "gr_nm") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT household_id, gr_nm, sales, gr_sales_rank FROM (
  SELECT *, row_number() OVER ({part} ORDER BY gr_sales_rank, household_id) AS _k FROM {source})
WHERE _k <= ({limit_sql})"""


SALES_OUT = "household_id, gr_nm, CAST(sales AS DOUBLE) / 10000 AS sales, gr_sales_rank"

# ---- chain A pieces --------------------------------------------------------

POOL = [
    ("pool_rank", _rank("snap", "pool_groups")),
    ("pool_long", """
SELECT household_id, gr_nm, gr_sales_rank AS rank, count(*) OVER (PARTITION BY household_id) AS n_gr FROM pool_rank"""),
    ("pool_hh", """
SELECT household_id, count(*) AS n_gr, count(DISTINCT gr_nm) AS n_keys,
       string_agg(gr_nm, ',' ORDER BY gr_nm) AS gr_nm_list,
       string_agg(gr_nm || ':' || CAST(gr_sales_rank AS VARCHAR), ',' ORDER BY gr_nm) AS gr_rank_map
FROM pool_rank GROUP BY household_id"""),
    ("spec", "SELECT gr_nm, ca_nm, (base * (SELECT n FROM ncust)) // 1500 AS n_ca FROM (VALUES "
             + ", ".join(f"({_q(g)}, {_q(c)}, {b})" for g, c, b in S.ALLOC_SPEC_BASE)
             + ") t(gr_nm, ca_nm, base)"),
]

PICK_COLS = "household_id, ca_nm, gr_nm, n_gr, rank, pass_n, step"


def _allocation(sizes=(1, 2, 3, 4)) -> tuple[list[tuple[str, str]], str, set[str]]:
    """One CTE per (pass, step); the order of a pass is computed in SQL from
    the picks before it. Returns (ctes, name of the cumulative picks, materialized)."""
    ctes = [("pick_0", "SELECT CAST(NULL AS BIGINT) AS household_id, CAST(NULL AS VARCHAR) AS ca_nm, "
                       "CAST(NULL AS VARCHAR) AS gr_nm, CAST(NULL AS BIGINT) AS n_gr, CAST(NULL AS BIGINT) AS rank, "
                       "CAST(NULL AS BIGINT) AS pass_n, CAST(NULL AS BIGINT) AS step WHERE false")]
    mat = {"pool_rank", "pool_long", "pick_0"}
    cur = "pick_0"
    steps = len(S.ALLOC_SPEC_BASE)
    for n in sizes:
        ord_name = f"ord_{n}"
        ctes.append((ord_name, f"""
SELECT s.gr_nm, s.ca_nm, s.n_ca,
       row_number() OVER (ORDER BY CAST(greatest(0, s.n_ca - coalesce(d.k, 0)) AS DOUBLE) / s.n_ca DESC,
                                   s.ca_nm, s.gr_nm) AS pos
FROM spec s LEFT JOIN (SELECT ca_nm, count(*) AS k FROM {cur} GROUP BY ca_nm) d USING (ca_nm)
WHERE s.n_ca > 0"""))
        mat.add(ord_name)
        for k in range(1, steps + 1):
            st, cum = f"st_{n}_{k}", f"pick_{n}_{k}"
            ctes.append((st, f"""
SELECT p.household_id, o.ca_nm, p.gr_nm, p.n_gr, p.rank, CAST({n} AS BIGINT) AS pass_n, CAST({k} AS BIGINT) AS step
FROM pool_long p
JOIN {ord_name} o ON o.pos = {k} AND p.gr_nm = o.gr_nm
LEFT JOIN (SELECT ca_nm, count(*) AS k FROM {cur} GROUP BY ca_nm) d ON d.ca_nm = o.ca_nm
WHERE p.n_gr = {n} AND p.household_id NOT IN (SELECT household_id FROM {cur})
QUALIFY row_number() OVER (ORDER BY p.rank, p.household_id) <= greatest(0, o.n_ca - coalesce(d.k, 0))"""))
            ctes.append((cum, f"SELECT {PICK_COLS} FROM {cur} UNION ALL SELECT {PICK_COLS} FROM {st}"))
            mat.update({st, cum})
            cur = cum
    return ctes, cur, mat


def _alloc_query(body_fn, sizes=(1, 2, 3, 4)) -> str:
    ctes, picks, mat = _allocation(sizes)
    return _with(POOL + ctes, body_fn(picks), mat)


PREVIEW = ("preview", """
SELECT household_id, ca_nm, gr_nm, n_gr, rank FROM (
  SELECT p.household_id, s.ca_nm, p.gr_nm, p.n_gr, p.rank, s.n_ca,
         row_number() OVER (PARTITION BY s.ca_nm, s.gr_nm ORDER BY p.rank, p.household_id) AS _k
  FROM pool_long p JOIN spec s USING (gr_nm) WHERE p.n_gr = 2)
WHERE _k <= n_ca""")

FREQ = ("freq", f"""
SELECT household_id, CAST(sales AS DOUBLE) / 10000 AS sales, new_gr AS gr_nm,
       row_number() OVER (PARTITION BY base_gr, times_buy ORDER BY sales DESC, household_id) AS gr_sales_rank
FROM (SELECT gr_nm AS base_gr, household_id, sales, times_buy, gr_nm || '_' || times_buy AS new_gr
      FROM (SELECT gr_nm, household_id, sum(net_spend_amt) AS sales,
                   CASE WHEN count(DISTINCT transaction_uid) = 1 THEN 'onetime' ELSE 'multitimes' END AS times_buy
            FROM snap JOIN pool_groups USING (upc_id) WHERE gr_nm IN {_in(S.FREQ_GROUPS)} GROUP BY 1, 2))
WHERE new_gr NOT IN {_in(S.FREQ_DROP)}""")

# ---- chain B pieces --------------------------------------------------------

DRINKS = "('tea', 'coffee', 'cocoa', 'juice', 'soda')"


def _shelf(name: str, txn: str, shelves: str, n: int, excluded: str, label: str, quota: str) -> list[tuple[str, str]]:
    """Candidates, pooled rank and picks of one shelf stage over the lines ``txn``."""
    return [
        (f"cand_{name}", f"""
SELECT household_id FROM {txn} JOIN wf_groups USING (upc_id)
WHERE gr_nm IN {shelves} AND upc_id NOT IN (SELECT upc_id FROM wf_groups WHERE gr_nm IN {excluded})
GROUP BY household_id HAVING count(DISTINCT gr_nm) = {n}"""),
        (f"rank_{name}", _rank(txn, "wf_groups", label=label, where=f"gr_nm IN {shelves}")),
        (f"pick_{name}", _limit(f"(SELECT r.* FROM cand_{name} JOIN rank_{name} r USING (household_id))", quota, by="")),
    ]


WATERFALL = [
    ("fam", f"SELECT * FROM wf_groups WHERE gr_nm IN {DRINKS}"),
    ("fam_rank", _rank("snap", "fam")),
    ("loyal", """
SELECT household_id, min(gr_nm) AS gr_nm FROM snap JOIN fam USING (upc_id)
GROUP BY household_id HAVING count(DISTINCT gr_nm) = 1"""),
    ("loyal_rank", "SELECT r.* FROM loyal JOIN fam_rank r USING (household_id, gr_nm)"),
    ("one_drink", _limit("loyal_rank", "SELECT drink FROM quota")),
    ("txn_a", "SELECT * FROM snap WHERE household_id NOT IN (SELECT household_id FROM one_drink)"),
    ("sup", """
SELECT upc_id, CASE gr_nm WHEN 'cocoa' THEN 'sweet' WHEN 'juice' THEN 'cold' WHEN 'soda' THEN 'cold' ELSE 'hot' END AS gr_nm
FROM fam"""),
    ("super_rank", _rank("txn_a", "sup")),
    ("sets", """
SELECT household_id, string_agg(DISTINCT gr_nm, '+' ORDER BY gr_nm) AS st FROM txn_a JOIN sup USING (upc_id)
GROUP BY household_id"""),
    ("mapped", """
SELECT r.* FROM sets JOIN (VALUES ('hot', 'hot'), ('cold', 'cold'), ('hot+sweet', 'sweet'), ('cold+hot+sweet', 'cold'))
  m(st, target) USING (st) JOIN super_rank r ON r.household_id = sets.household_id AND r.gr_nm = m.target"""),
    ("by_set", _limit("mapped", "SELECT super FROM quota")),
    ("txn_b", "SELECT * FROM txn_a WHERE household_id NOT IN (SELECT household_id FROM by_set)"),
    ("snackers", """
SELECT household_id, 'snackers' AS gr_nm FROM txn_b JOIN wf_groups USING (upc_id)
WHERE gr_nm IN ('snacks', 'bakery') GROUP BY household_id HAVING count(DISTINCT gr_nm) = 2"""),
    ("txn_c", "SELECT * FROM txn_b WHERE household_id NOT IN (SELECT household_id FROM snackers)"),
    *_shelf("large", "txn_c", "('shelf_large')", 1, "('juice', 'soda')", "large_no_cold", "SELECT 8 * drink FROM quota"),
    ("txn_d", "SELECT * FROM txn_c WHERE household_id NOT IN (SELECT household_id FROM pick_large)"),
    *_shelf("mixed", "txn_d", "('shelf_promo', 'shelf_medium')", 2, "('tea')", "promo_medium_no_tea",
            "SELECT 15 * drink FROM quota"),
    ("combined", """
SELECT household_id, gr_nm, gr_sales_rank FROM one_drink
UNION ALL SELECT household_id, gr_nm, gr_sales_rank FROM by_set
UNION ALL SELECT household_id, gr_nm, CAST(NULL AS BIGINT) FROM snackers
UNION ALL SELECT household_id, gr_nm, gr_sales_rank FROM pick_large
UNION ALL SELECT household_id, gr_nm, gr_sales_rank FROM pick_mixed"""),
]
WF_MAT = {"fam_rank", "one_drink", "txn_a", "super_rank", "by_set", "txn_b", "snackers", "txn_c", "pick_large", "txn_d",
          "pick_mixed", "combined"}

LABELS = _in(S.SEGMENT_LABELS + [FILL])
SPLIT = _segments(LAST_WEEK) + [
    ("aseg", f"""
SELECT c.household_id, c.gr_nm, c.gr_sales_rank, coalesce(s.seg_desc, {_q(FILL)}) AS seg_desc
FROM combined c LEFT JOIN seg s USING (household_id)"""),
]


def _split(no_control) -> tuple[str, str]:
    first = f"WHEN gr_nm IN {_in(no_control)} THEN 'test' " if no_control else ""
    return ("split", f"""
SELECT household_id, gr_nm, seg_desc, gr_sales_rank,
       CASE {first}WHEN CAST(('0x' || substr(md5(CAST(household_id AS VARCHAR) || ':{S.SALT}'), 1, 8)) AS BIGINT)
                     < (CASE WHEN seg_desc IN {LABELS} THEN {C.CONTROL_FRACTION} ELSE 0.0 END) * 4294967296.0
                THEN 'ctrl' ELSE 'test' END AS arm
FROM aseg""")


def _wf(body: str, extra=()) -> str:
    return _with(WATERFALL + list(extra), body, WF_MAT)


# ---- chain C pieces --------------------------------------------------------

def _shop_cycle(name: str, filt: str) -> tuple[str, str]:
    return (name, f"""
SELECT household_id, quantile_disc(date_diff, 0.5) AS med_shp_cyc_day FROM (
  SELECT household_id, datediff('day', lag(date_id) OVER (PARTITION BY household_id ORDER BY date_id), date_id) AS date_diff
  FROM (SELECT DISTINCT household_id, date_id FROM snap {filt}))
WHERE date_diff IS NOT NULL GROUP BY household_id""")


IN_CLS = "WHERE upc_id IN (SELECT upc_id FROM cls)"
CYCLE = [
    ("daily", f"SELECT household_id, date_id, sum(pkg_weight_unit) AS units FROM snap {IN_CLS} GROUP BY 1, 2"),
    ("gaps", """
SELECT household_id, date_id, units, datediff('day', d1, date_id) AS gap_days, datediff('day', d2, d1) AS gap_before FROM (
  SELECT *, lag(date_id) OVER w AS d1, lag(date_id, 2) OVER w AS d2 FROM daily
  WINDOW w AS (PARTITION BY household_id ORDER BY date_id)) WHERE d1 IS NOT NULL"""),
    ("rhythm", f"""
SELECT household_id, max(date_id) AS last_date, count(*) AS n_gaps,
       quantile_disc(CAST(gap_days AS DOUBLE) / units, 0.5) AS days_per_unit,
       coalesce(arg_max(gap_days, date_id) * {C.SMOOTHING_ALPHA}::DOUBLE
                + arg_max_null(gap_before, date_id) * {1 - C.SMOOTHING_ALPHA}::DOUBLE,
                CAST(arg_max(gap_days, date_id) AS DOUBLE)) AS cycle_days
FROM gaps GROUP BY household_id"""),
]


def _cyc(body: str, extra=()) -> str:
    return _with(CYCLE + list(extra), body)


def oracle_sql() -> dict[str, str]:
    picks_out = lambda p: f"SELECT {PICK_COLS} FROM {p}"
    split_nc = _split(S.NO_CONTROL)
    hashed = ("hashed", """
SELECT sp.household_id, sp.gr_nm, sp.arm, c.hashed_id FROM split sp
LEFT JOIN (SELECT DISTINCT c_custkey AS household_id, sha256(c_name) AS hashed_id FROM customer) c USING (household_id)""")
    return {
        "snapshot_profile": _with(_segments(str(S.TOPK_END_WEEK)) + [
            ("s", f"SELECT * FROM snap WHERE week_id BETWEEN {S.TOPK_START_WEEK} AND {S.TOPK_END_WEEK} "
                  f"AND channel = {_q(S.SNAP_PROFILE_CHANNEL)}"),
            ("per_hh", """
SELECT household_id, count(*) AS n_lines, min(week_id) AS min_week, max(week_id) AS max_week,
       min(date_id) AS min_date, max(date_id) AS max_date, sum(net_spend_amt) AS spend FROM s GROUP BY household_id""")],
            f"""
SELECT coalesce(seg.seg_desc, {_q(FILL)}) AS seg_desc, CAST(sum(n_lines) AS BIGINT) AS n_lines,
       count(*) AS n_households, min(min_week) AS min_week, max(max_week) AS max_week,
       min(min_date) AS min_date, max(max_date) AS max_date, CAST(sum(spend) AS DOUBLE) / 10000 AS spend
FROM per_hh LEFT JOIN seg USING (household_id) GROUP BY 1"""),
        "segment_as_of": _with(_segments(LAST_WEEK),
                               "SELECT household_id, seg_desc, CAST((SELECT p FROM seg_pick) AS BIGINT) AS period_id FROM seg"),
        "product_groups": _with([], "SELECT gr_nm, count(*) AS n_rows, count(DISTINCT upc_id) AS n_products "
                                    "FROM wf_groups GROUP BY gr_nm"),
        "group_reach": _with([], "SELECT gr_nm, count(DISTINCT household_id) AS n_households "
                                 "FROM snap JOIN wf_groups USING (upc_id) GROUP BY gr_nm"),
        "class_products": _with([], "SELECT upc_id FROM cls"),
        "sales_top_k": _with([("r", _rank("snap", "pool_groups",
                                          where=f"week_id BETWEEN {S.TOPK_START_WEEK} AND {S.TOPK_END_WEEK}"))],
                             f"SELECT {SALES_OUT} FROM r WHERE gr_sales_rank <= {S.TOPK_PER_GROUP}"),
        "sales_rank": _with(POOL, f"SELECT {SALES_OUT} FROM pool_rank"),
        "frequency_rank": _with([FREQ], "SELECT * FROM freq"),
        "rank_union": _with([FREQ,
                             ("p2", _rank("snap", "pool_groups", where=f"channel = 'delivery' AND gr_nm = {_q(S.DELIVERY_GROUP)}")),
                             ("p3", _rank("snap", "pool_groups", where=f"gr_nm = {_q(S.PLAIN_GROUP)}"))], f"""
SELECT household_id, gr_nm, sales, gr_sales_rank FROM freq
UNION ALL SELECT {SALES_OUT} FROM p2 UNION ALL SELECT {SALES_OUT} FROM p3"""),
        "group_list": _with(POOL, "SELECT household_id, gr_nm_list, n_gr FROM pool_hh"),
        "rank_map": _with(POOL, "SELECT household_id, n_gr, gr_rank_map FROM pool_hh"),
        "pool_check": _with(POOL, """
SELECT n_gr, count(*) AS n_households, CAST(sum(CASE WHEN n_gr <> n_keys THEN 1 ELSE 0 END) AS BIGINT) AS n_mismatch
FROM pool_hh GROUP BY n_gr"""),
        "combination_report": _with(POOL, "SELECT n_gr, gr_nm_list, count(*) AS n_households FROM pool_hh GROUP BY 1, 2"),
        "rank_drilldown": _with(POOL, f"""
SELECT {SALES_OUT} FROM pool_rank WHERE household_id IN (
  SELECT household_id FROM pool_rank WHERE gr_nm = {_q(S.DRILL_GROUP)} AND gr_sales_rank = {S.DRILL_RANK})"""),
        "allocation_pass1": _alloc_query(picks_out, sizes=(1,)),
        "remaining_quota": _alloc_query(lambda p: f"""
SELECT s.gr_nm, s.ca_nm, s.n_ca, coalesce(d.k, 0) AS n_allctd, greatest(0, s.n_ca - coalesce(d.k, 0)) AS to_alloc,
       round(CASE WHEN s.n_ca = 0 THEN NULL
                  ELSE CAST(greatest(0, s.n_ca - coalesce(d.k, 0)) AS DOUBLE) / s.n_ca END, 6) AS prop_to_alloc,
       CASE WHEN s.n_ca > 0 THEN row_number() OVER (ORDER BY CASE WHEN s.n_ca > 0 THEN
         CAST(greatest(0, s.n_ca - coalesce(d.k, 0)) AS DOUBLE) / s.n_ca END DESC NULLS LAST, ca_nm, gr_nm) END AS position
FROM spec s LEFT JOIN (SELECT ca_nm, count(*) AS k FROM {p} GROUP BY ca_nm) d USING (ca_nm)""", sizes=(1,)),
        "available_by_size": _alloc_query(lambda p: f"""
SELECT n_gr, count(*) AS n_available FROM pool_hh
WHERE household_id NOT IN (SELECT household_id FROM {p}) GROUP BY n_gr""", sizes=(1,)),
        "allocation_full": _alloc_query(lambda p: f"""
SELECT h.household_id, h.n_gr, h.gr_nm_list, a.ca_nm FROM pool_hh h LEFT JOIN {p} a USING (household_id)"""),
        "allocation_audit": _alloc_query(picks_out),
        "allocation_profile": _alloc_query(lambda p: f"""
SELECT ca_nm, min(rank) AS min_rank, max(rank) AS max_rank, count(*) AS n_households FROM {p} GROUP BY ca_nm"""),
        "preview_top_k": _with(POOL + [PREVIEW], "SELECT * FROM preview", {"pool_rank"}),
        "snapshot_conflicts": _with(POOL + [PREVIEW], """
SELECT household_id, count(*) AS n_picks, string_agg(ca_nm, ',' ORDER BY ca_nm) AS audiences
FROM preview GROUP BY household_id HAVING count(*) > 1""", {"pool_rank"}),
        "overlap_candidates": _with(POOL + [("aud", "SELECT * FROM (VALUES " + ", ".join(
            f"({_q(ca)}, {_q(g)})" for ca, gs in S.AUDIENCE_SETS for g in gs) + ") t(ca_nm, gr_nm)")],
            "SELECT DISTINCT p.household_id, a.ca_nm, p.n_gr FROM pool_long p JOIN aud a USING (gr_nm)"),
        "exclusive_shoppers": _wf(f"SELECT {SALES_OUT} FROM loyal_rank"),
        "quota_top_k": _wf(f"SELECT {SALES_OUT} FROM one_drink"),
        "cut_tail": _wf(f"""
SELECT {SALES_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY gr_nm ORDER BY gr_sales_rank DESC, household_id DESC) AS _e FROM one_drink)
WHERE _e <= {S.CUT_TAIL_WIDTH}"""),
        "super_group_rank": _wf(f"SELECT {SALES_OUT} FROM super_rank"),
        "set_mapping": _wf(f"SELECT {SALES_OUT} FROM mapped"),
        "waterfall_exclude": _wf("SELECT household_id, count(DISTINCT gr_nm) AS n_groups, count(*) AS n_lines "
                                 "FROM txn_b JOIN wf_groups USING (upc_id) GROUP BY household_id"),
        "bought_both": _wf("SELECT household_id, gr_nm FROM snackers"),
        "bought_excluding_lines": _wf("SELECT household_id FROM cand_mixed"),
        "pooled_rank_top_k": _wf(f"SELECT {SALES_OUT} FROM pick_large UNION ALL SELECT {SALES_OUT} FROM pick_mixed"),
        "combine_allocations": _wf("SELECT household_id, gr_nm, gr_sales_rank FROM combined"),
        "combine_check": _wf("SELECT count(*) AS n_rows, count(DISTINCT household_id) AS n_households FROM combined"),
        "waterfall_profile": _wf("""
SELECT gr_nm, min(gr_sales_rank) AS min_rank, max(gr_sales_rank) AS max_rank, count(*) AS n_households
FROM combined GROUP BY gr_nm"""),
        "alloc_segment": _wf("SELECT household_id, gr_nm, gr_sales_rank, seg_desc FROM aseg", SPLIT),
        "alloc_segment_inner": _wf("SELECT c.household_id, c.gr_nm, c.gr_sales_rank, s.seg_desc "
                                   "FROM combined c JOIN seg s USING (household_id)", SPLIT),
        "period_of": _with([], f"""
SELECT b AS back_days, (SELECT period_id FROM date_dim WHERE date_id = (SELECT max(date_id) FROM date_dim) - CAST(b AS INTEGER)) AS period_id
FROM (VALUES (0), ({C.SEGMENT_LOOKBACK_DAYS})) t(b)"""),
        "snapshot_with_segment": _with(_segments(LAST_WEEK), f"""
SELECT coalesce(seg_desc, {_q(FILL)}) AS seg_desc, count(*) AS n_lines, count(DISTINCT household_id) AS n_households
FROM snap LEFT JOIN seg USING (household_id) WHERE channel = {_q(S.SNAP_PROFILE_CHANNEL)} GROUP BY 1"""),
        "spec_csv": "SELECT DISTINCT p_brand AS ca_nm, p_type AS gr_nm FROM part UNION ALL SELECT * FROM (VALUES "
                    + ", ".join(f"({_q(ca)}, {_q(g)})" for ca, gs in S.AUDIENCE_SETS for g in gs) + ") t(ca_nm, gr_nm)",
        "prefix_parts": """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN p_size END AS p_size, CASE WHEN p_size > 10 THEN p_brand END AS p_brand
FROM part WHERE p_size <= 30""",
        "folder_union": """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN p_size END AS p_size,
       CASE WHEN p_size > 10 AND p_size <= 30 THEN p_brand END AS p_brand, CASE WHEN p_size > 30 THEN p_type END AS p_type
FROM part""",
        "part_counts": """
SELECT CASE WHEN p_size <= 10 THEN 'rank_a' WHEN p_size <= 30 THEN 'rank_b' ELSE 'other' END AS part, count(*) AS n_rows
FROM part GROUP BY 1""",
        "snapshot_refresh": _with([], """
SELECT week_id, count(*) AS n_lines, count(DISTINCT household_id) AS n_households, CAST(sum(net_spend_amt) AS DOUBLE) / 10000 AS spend
FROM snap GROUP BY week_id"""),
        "reach_by_weeks": _with([], " UNION ALL ".join(
            f"SELECT gr_nm, {_q(label)} AS weeks, count(DISTINCT household_id) AS n_households FROM snap JOIN wf_groups USING (upc_id) "
            f"WHERE week_id BETWEEN {lo} AND {hi} GROUP BY gr_nm" for label, (lo, hi) in S.REACH_RANGES.items())),
        "except_distinct": _with(POOL + [("parity", f"""
SELECT household_id, CASE WHEN count(*) > 1 THEN count(*) END AS size,
       string_agg(gr_nm || ':' || CAST(gr_sales_rank % {S.RANK_PARITY} AS VARCHAR), ',' ORDER BY gr_nm) AS gr_rank_map
FROM pool_rank GROUP BY household_id""")],
            "SELECT size, gr_rank_map FROM parity EXCEPT SELECT size, gr_rank_map FROM parity WHERE household_id % 2 = 0", {"pool_rank"}),
        "reconcile_cycles": _with(CYCLE + [_shop_cycle("one_channel", f"WHERE channel = {_q(S.SNAP_PROFILE_CHANNEL)}")], """
SELECT coalesce(r.household_id, s.household_id) AS household_id, r.cycle_days, s.med_shp_cyc_day,
       CASE WHEN s.household_id IS NULL THEN 'left' WHEN r.household_id IS NULL THEN 'right' ELSE 'both' END AS found_in
FROM rhythm r FULL OUTER JOIN one_channel s ON r.household_id = s.household_id"""),
        "channel_pivot": _with([], "SELECT household_id, " + ", ".join(
            f"CAST(sum(CASE WHEN channel = '{c}' THEN net_spend_amt END) AS DOUBLE) / 10000 AS spend_{c}"
            for c in ("delivery", "pickup", "store")) + " FROM snap GROUP BY household_id"),
        "spec_rejects": f"""
WITH l AS (SELECT p_brand AS gr_nm, CASE WHEN p_size % 9 <> 0 THEN p_type || '_' || CAST(p_partkey % {S.SPEC_AUDIENCES} AS VARCHAR) END AS ca_nm,
             p_size FROM part),
j AS (SELECT *, CASE WHEN p_size % 10 = 0 THEN 'malformed' WHEN ca_nm IS NULL THEN 'missing ca_nm'
                     WHEN p_size % 7 = 0 THEN 'negative quota' END AS reason FROM l),
k AS (SELECT *, count(*) OVER (PARTITION BY gr_nm, ca_nm, reason IS NULL) AS copies FROM j)
SELECT coalesce(reason, CASE WHEN copies > 1 THEN 'duplicate' ELSE 'used' END) AS reason, count(*) AS n_rows,
       CAST(sum(CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 7 = 0 THEN -p_size ELSE p_size END) AS BIGINT) AS n_ca
FROM k GROUP BY 1""",
        "probability_sql": _cyc(f"""
SELECT household_id, d AS days_to_start,
       round(CASE WHEN cycle_days > 0
                  THEN exp(-CAST(greatest(d, 0) AS DOUBLE) / cycle_days)
                       - exp(-CAST(greatest(d + {C.CAMPAIGN_DAYS}, 0) AS DOUBLE) / cycle_days) END, 6) AS chance
FROM (SELECT *, datediff('day', last_date, DATE '{S.CAMPAIGN_START}') AS d FROM rhythm)"""),
        "default_load": "SELECT s_suppkey, s_nationkey FROM supplier",
        "stratified_split": _wf("SELECT household_id, gr_nm, seg_desc, arm FROM split", SPLIT + [_split(())]),
        "split_no_control": _wf("SELECT household_id, gr_nm, seg_desc, arm FROM split", SPLIT + [split_nc]),
        "split_summary": _wf("""
SELECT gr_nm, CAST(sum(CASE WHEN arm = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS n_test,
       CAST(sum(CASE WHEN arm = 'ctrl' THEN 1 ELSE 0 END) AS BIGINT) AS n_ctrl, count(*) AS n_total
FROM split GROUP BY gr_nm""", SPLIT + [split_nc]),
        "hashed_ids": _wf("SELECT * FROM hashed", SPLIT + [split_nc, hashed]),
        "export_lists": _wf(f"""
SELECT l.gr_nm, l.arm, count(h.household_id) AS n_households,
       CAST(count(CASE WHEN h.household_id % {S.NO_ID_MODULUS} = 0 THEN 1 END) AS BIGINT) AS n_without_id,
       CAST(count(CASE WHEN h.household_id % {S.NO_ID_MODULUS} <> 0 THEN 1 END) AS BIGINT) AS n_rows
FROM (SELECT DISTINCT gr_nm, unnest(['test', 'ctrl']) AS arm FROM named) l LEFT JOIN named h USING (gr_nm, arm)
GROUP BY 1, 2""", SPLIT + [split_nc, ("named", "SELECT * REPLACE (CASE gr_nm "
                    + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in S.EXPORT_NAMES.items())
                    + " ELSE gr_nm END AS gr_nm) FROM split")]),
        "sample_by_split": _wf(f"""
SELECT seg_desc, count(*) AS n_rows, count(DISTINCT household_id) AS n_households, true AS in_one_arm,
       true AS share_in_bound FROM aseg WHERE gr_nm NOT IN {_in(S.NO_CONTROL)} GROUP BY 1""", SPLIT),
        "purchase_cycle": _cyc("SELECT * FROM gaps"),
        "usage_rate": _cyc("SELECT household_id, days_per_unit FROM rhythm"),
        "smoothed_cycle": _cyc("SELECT household_id, cycle_days, n_gaps FROM rhythm"),
        "recency": _cyc("SELECT household_id, last_date, cycle_days FROM rhythm"),
        "purchase_probability": _cyc(f"""
SELECT household_id, last_date, cycle_days, d AS days_to_start,
       round(CASE WHEN cycle_days > 0
                  THEN exp(-CAST(greatest(d, 0) AS DOUBLE) / cycle_days)
                       - exp(-CAST(greatest(d + {C.CAMPAIGN_DAYS}, 0) AS DOUBLE) / cycle_days) END, 6) AS chance
FROM (SELECT *, datediff('day', last_date, DATE '{S.CAMPAIGN_START}') AS d FROM rhythm)"""),
        "shopping_cycle": _with([_shop_cycle("sc", IN_CLS)], "SELECT * FROM sc"),
        "dominant_cycle": _with([
            _shop_cycle("tc", IN_CLS), _shop_cycle("ac", ""),
            ("share", """
SELECT household_id, CAST(g AS DOUBLE) / CAST(t AS DOUBLE) AS share
FROM (SELECT household_id, sum(net_spend_amt) AS g FROM snap WHERE upc_id IN (SELECT upc_id FROM cls) GROUP BY 1)
JOIN (SELECT household_id, sum(net_spend_amt) AS t FROM snap GROUP BY 1) USING (household_id)"""),
            ("med", "SELECT quantile_disc(share, 0.5) AS m FROM share")], """
SELECT s.household_id, round(s.share, 6) AS share, s.share > (SELECT m FROM med) AS dominant,
       CASE WHEN s.share > (SELECT m FROM med) THEN tc.med_shp_cyc_day ELSE ac.med_shp_cyc_day END AS cycle_days
FROM share s LEFT JOIN tc USING (household_id) LEFT JOIN ac USING (household_id)"""),
        "next_shop_median": _with([_shop_cycle("sc", "")], """
SELECT l.household_id, l.last_date_id, sc.med_shp_cyc_day, l.last_date_id + CAST(sc.med_shp_cyc_day AS INTEGER) AS next_date_id
FROM (SELECT household_id, max(date_id) AS last_date_id FROM snap GROUP BY 1) l JOIN sc USING (household_id)"""),
        "next_shop_consumption": _cyc("""
SELECT l.household_id, l.last_date_id, l.last_units, round(r.med_units_per_day, 6) AS med_units_per_day,
       round(l.last_units / r.med_units_per_day, 6) AS next_days,
       l.last_date_id + CAST(ceil(l.last_units / r.med_units_per_day) AS INTEGER) AS next_date_id
FROM (SELECT household_id, max(date_id) AS last_date_id, arg_max(units, date_id) AS last_units FROM daily GROUP BY 1) l
JOIN (SELECT household_id, quantile_disc(units / CAST(datediff('day', date_id, nxt) AS DOUBLE), 0.5) AS med_units_per_day
      FROM (SELECT *, lead(date_id) OVER (PARTITION BY household_id ORDER BY date_id) AS nxt FROM daily)
      WHERE nxt IS NOT NULL GROUP BY household_id) r USING (household_id)"""),
    }
