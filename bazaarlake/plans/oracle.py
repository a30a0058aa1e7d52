"""For each registered query the same result in plain SQL, written from the
definition and not from the operator."""

from __future__ import annotations

from bazaarlake.plans.catalog import SEGMENTS
from bazaarlake.sources.sample import EVENT_DAY, FEED_DAYS, ORDER_DAY, SNAPSHOT_DAYS

BO = f"DATE '{ORDER_DAY}'"
BE = f"DATE '{EVENT_DAY}'"


def _ratio(n: str, d: str, times: int, scale: int) -> str:
    """times * n / d rounded half up to `scale` decimals, in whole numbers, since
    rounding a double is one cent off on some exact halves."""
    whole = "CAST(CAST({} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    top, base = whole.format(n), f"nullif({whole.format(d)}, 0)"
    return (
        f"CAST(sign({top}) * ((2 * abs({top}) * {times * 10**scale} + {base}) // (2 * {base})) AS DOUBLE)"
        f" / {10**scale}"
    )


def pct(n: str, d: str) -> str:
    return _ratio(n, d, 100, 2)


def div(n: str, d: str, scale: int = 2) -> str:
    return _ratio(n, d, 1, scale)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def money(x: str, where: str | None = None) -> str:
    keep = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(coalesce(sum({x}){keep}, 0) AS DOUBLE)"


def growth(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {pct(f'({n} - {d})', d)} END"


PARTS = {
    "o": """o AS (
      SELECT o_orderkey AS id, o_custkey AS user_id,
             CASE o_orderstatus WHEN 'O' THEN 'UNPAID' WHEN 'P' THEN 'PAID' WHEN 'F' THEN 'COMPLETED'
                  ELSE 'UNKNOWN' END AS status,
             CASE WHEN o_orderstatus IN ('P', 'F') THEN 1 ELSE 0 END AS paid,
             CAST(o_totalprice AS DECIMAL(16,2)) AS amt,
             CAST(o_orderkey % 10 AS DECIMAL(16,2)) AS fee, CAST(o_orderkey % 7 * 0.5 AS DECIMAL(16,2)) AS cut,
             CAST(CAST(o_totalprice AS DECIMAL(16,2)) - o_orderkey % 10 AS DECIMAL(16,2)) AS goods,
             CAST(o_orderdate AS DATE) AS day,
             strftime(o_orderdate, '%Y-%m-%d') AS date_id,
             o_orderpriority, o_orderdate
      FROM orders)""",
    "l": """l AS (
      SELECT l_orderkey AS order_id, o.user_id, l_partkey AS sku_id, l_linenumber,
             CAST(l_quantity AS BIGINT) AS num, CAST(l_extendedprice AS DECIMAL(16,2)) AS amt,
             CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
             l_returnflag AS rf, l_linestatus AS ls, l_shipdate, o.paid, o.day, o.date_id, o.o_orderdate
      FROM lineitem JOIN o ON l_orderkey = o.id)""",
    "rl": """rl AS (
      SELECT l_orderkey AS order_id, o.user_id, l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS num,
             CAST(l_extendedprice AS DECIMAL(16,2)) AS amt, CAST(l_shipdate AS DATE) AS day,
             strftime(l_shipdate, '%Y-%m-%d') AS date_id
      FROM lineitem JOIN o ON l_orderkey = o.id WHERE l_returnflag = 'R')""",
    "lr": """lr AS (
      SELECT order_id, user_id, sku_id, num, amt, paid, day, date_id, 0 AS back FROM l
      UNION ALL SELECT order_id, user_id, sku_id, num, amt, 0, day, date_id, 1 FROM rl)""",
    "lrp": """lrp AS (SELECT lr.*, p.tm_id, p.c2, p.c3, p.sku_name FROM lr LEFT JOIN p USING (sku_id))""",
    "p": """p AS (
      SELECT p_partkey AS sku_id, p_name AS sku_name, p_brand AS tm_id, p_type AS c2,
             p_type || '/' || CAST(p_size // 10 AS VARCHAR) AS c3,
             CAST(p_retailprice AS DECIMAL(16,2)) AS price
      FROM part)""",
    "lp": """lp AS (SELECT l.*, p.tm_id, p.c2, p.c3, p.sku_name FROM l LEFT JOIN p USING (sku_id))""",
    "op": """op AS (
      SELECT o.*, c_nationkey AS province_id, n_name AS province_name, n_regionkey AS region_id,
             r_name AS region_name
      FROM o LEFT JOIN customer ON o.user_id = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "e": """e AS (
      SELECT event_id, ts, user_id, event_type, value,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id,
             CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS date_id
      FROM events)""",
    "a": """a AS (
      SELECT e.*, CAST(value AS DECIMAL(16,2)) AS amt,
             CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'cart_add'
                  WHEN 'signup' THEN 'favor_add' WHEN 'purchase' THEN 'order' END AS code,
             CASE WHEN event_type = 'purchase' AND value > 0 THEN 1 ELSE 0 END AS paid
      FROM e WHERE event_type IN ('view', 'click', 'signup', 'purchase'))""",
    "r": "r(k) AS (VALUES (1), (7), (30))",
    "f": f"""f AS (
      SELECT id, dt, user_level FROM (
        SELECT o_custkey AS id, o_orderpriority AS user_level,
               CASE WHEN o_orderdate < DATE '{FEED_DAYS[0]}' + 1 THEN '{FEED_DAYS[0]}'
                    WHEN o_orderdate < DATE '{FEED_DAYS[1]}' + 1 THEN '{FEED_DAYS[1]}'
                    ELSE '{FEED_DAYS[2]}' END AS dt, o_orderdate, o_orderkey
        FROM orders)
      QUALIFY row_number() OVER (PARTITION BY id, dt ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""",
    "raw": """raw AS (
      SELECT event_id AS line_id,
             CASE event_id % 40 WHEN 0 THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
                  WHEN 3 THEN strftime(ts, '%Y-%-m-%-d %H:%M:%S')
                  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS t,
             strftime(ts, '%Y-%m-%d %H:%M:%S') AS good_t,
             'user' || user_id AS u, '192.168.1.' || (user_id % 255) AS ip, event_type AS act,
             CASE event_id % 40 WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'product' || sku_id END AS prod,
             event_id % 40 AS kind
      FROM e)""",
    # What the mildest strategy that keeps 95 % of the lines leaves: 0 strict, 1 repair, 2 fill.
    "c": f"""c AS (
      SELECT line_id, CASE WHEN k = 0 THEN t ELSE good_t END AS event_time, u AS "user", ip, act AS action,
             CASE WHEN prod IS NULL THEN 'unknown' WHEN prod = '' THEN 'unknown_product' ELSE prod END AS product
      FROM raw, (SELECT CASE WHEN {pct('s0', 'total')} >= 95 THEN 0 WHEN {pct('s1', 'total')} >= 95 THEN 1 ELSE 2 END AS k
                 FROM (SELECT count(*) AS total, count(*) FILTER (WHERE kind > 3) AS s0,
                              count(*) FILTER (WHERE kind NOT IN (1, 2)) AS s1 FROM raw)) chosen
      WHERE k = 2 OR kind > 3 OR (k = 1 AND kind NOT IN (1, 2)))""",
}
NEEDS = {
    "l": ["o"],
    "rl": ["o"],
    "lr": ["l", "rl"],
    "lrp": ["lr", "p"],
    "lp": ["l", "p"],
    "op": ["o"],
    "a": ["e"],
    "raw": ["e"],
    "c": ["raw"],
}
LINE = "concat_ws(',', t, u, ip, act, prod)"


def sql(parts: str, body: str) -> str:
    """The named parts and whatever they need, then the body. A body that starts
    with a comma adds its own parts."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        need(name)
    body = body.strip()
    if not ordered:
        return body
    joiner = "" if body.startswith(",") else "\n"
    return "WITH " + ",\n".join(PARTS[n] for n in ordered) + joiner + body


def _line_measures(keys: str, source: str = "l", recent: str | None = None) -> str:
    """Per keys: orders, pieces and money of the lines, and in the sources lr and lrp of the refunds."""
    group = f"{keys}, k" if recent else keys
    window = (
        f" JOIN r ON {source}.day > {recent} - r.k AND {source}.day <= {recent}" if recent else ""
    )
    k = "k, " if recent else ""
    rows, back = f"(SELECT *, 0 AS back FROM {source}) {source}", ""
    if source in ("lr", "lrp"):
        rows = source
        back = f""",
             count(*) FILTER (WHERE back = 1) AS refund_count,
             {big("coalesce(sum(num) FILTER (WHERE back = 1), 0)")} AS refund_num,
             coalesce(sum(amt) FILTER (WHERE back = 1), 0) AS refund_amt"""
    return f"""
      SELECT {k}{keys}, count(DISTINCT CASE WHEN back = 0 THEN order_id END) AS order_count,
             {big('coalesce(sum(num) FILTER (WHERE back = 0), 0)')} AS order_num,
             coalesce(sum(amt) FILTER (WHERE back = 0), 0) AS order_amt,
             count(DISTINCT CASE WHEN paid = 1 THEN order_id END) AS payment_count,
             {big('coalesce(sum(num) FILTER (WHERE paid = 1), 0)')} AS payment_num,
             coalesce(sum(amt) FILTER (WHERE paid = 1), 0) AS payment_amt{back}
      FROM {rows}{window} GROUP BY {group}"""


ORDER_SUMS = f"""count(DISTINCT id) AS order_count, count(DISTINCT user_id) AS order_user_count,
  {money('amt')} AS gmv, {div('sum(amt)', 'count(*)')} AS avg_order_amount"""
PAYMENT_SUMS = f"""count(*) FILTER (WHERE paid = 1) AS payment_count,
  count(DISTINCT CASE WHEN paid = 1 THEN user_id END) AS payment_user_count,
  {money('amt', 'paid = 1')} AS payment_amount"""
FREIGHT = f"{money('fee')} AS feight_fee, {money('cut')} AS discount_amount"
FAVORITE_PERIOD = """
        , h AS (SELECT user_id, CASE WHEN hour(ts) <= 6 THEN 0 WHEN hour(ts) <= 12 THEN 1
                     WHEN hour(ts) <= 18 THEN 2 ELSE 3 END AS period, count(*) AS n
                FROM a WHERE code = 'order' GROUP BY ALL),
        fp AS (SELECT user_id, CASE period WHEN 0 THEN 'dawn' WHEN 1 THEN 'morning' WHEN 2 THEN 'afternoon'
                        ELSE 'evening' END AS favorite_period
               FROM h QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, period) = 1)"""
PROVINCE = "province_id, province_name, region_id, region_name"
BIG_PROVINCE = f"{big('province_id')} AS province_id, province_name, {big('region_id')} AS region_id, region_name"


ORDER_DAY_SUMS = (
    "order_count", "order_user_count", "order_amount", "payment_count", "payment_user_count", "payment_amount",
)


def _rollup(unit: str, start: str, end: str) -> str:
    first = f"strftime({start}, '%Y-%m-%d') AS {unit}_start_date"
    zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ORDER_DAY_SUMS)
    return sql(
        "rl",
        f"""
        , od AS (
          SELECT {first}, strftime({end}, '%Y-%m-%d') AS {unit}_end_date,
                 count(DISTINCT id) AS order_count, count(DISTINCT user_id) AS order_user_count,
                 {money('amt')} AS order_amount, {PAYMENT_SUMS}
          FROM o GROUP BY 1, 2),
        rd AS (SELECT {first}, strftime({end}, '%Y-%m-%d') AS {unit}_end_date,
                      count(DISTINCT order_id) AS n, {money('amt')} AS amt FROM rl GROUP BY 1, 2)
        SELECT {unit}_start_date, {unit}_end_date, {zeros},
               coalesce(rd.n, 0) AS refund_count, coalesce(rd.amt, 0) AS refund_amount
        FROM od FULL JOIN rd USING ({unit}_start_date, {unit}_end_date)""",
    )


def _cohort_long(source: str, biz: str, offsets: str, back: int | None) -> str:
    since = f"HAVING min(day) >= {biz} - {back}" if back else ""
    return sql(
        source,
        f"""
        , d AS (SELECT DISTINCT user_id, day FROM {source} WHERE day <= {biz}),
        first AS (SELECT user_id, min(day) AS cohort FROM d GROUP BY 1 {since}),
        size AS (SELECT cohort, count(*) AS n FROM first GROUP BY 1),
        k(k) AS (VALUES {offsets})
        SELECT strftime(size.cohort, '%Y-%m-%d') AS cohort_day, {big('k.k')} AS retention_day,
               size.n AS new_user_count, count(d.user_id) AS retention_count,
               {pct('count(d.user_id)', 'size.n')} AS retention_rate,
               (SELECT count(*) FROM d x WHERE x.day = size.cohort + k.k) AS active_user_count
        FROM size JOIN k ON size.cohort + k.k <= {biz}
             JOIN first ON first.cohort = size.cohort
             LEFT JOIN d ON d.user_id = first.user_id AND d.day = first.cohort + k.k
        GROUP BY size.cohort, k.k, size.n""",
    )


def _detail_cell(k: int) -> str:
    back = f"count(*) FILTER (WHERE day = cohort + {k})"
    return f"""CASE WHEN cohort + {k} <= {BE} THEN {back} END AS day_{k}_retention,
      CASE WHEN cohort + {k} <= {BE} THEN {pct(back, 'count(DISTINCT user_id)')} END AS day_{k}_rate"""


def _repurchase(window: str) -> str:
    return sql(
        "l p",
        f"""
        , t AS (SELECT sku_id, user_id, order_id, min(day) AS day, sum(amt) AS amt FROM l {window} GROUP BY ALL),
        n AS (SELECT *, row_number() OVER (PARTITION BY sku_id, user_id ORDER BY day, order_id) AS i FROM t),
        s AS (SELECT sku_id, count(*) AS total_order_count, count(*) FILTER (WHERE i > 1) AS repurchase_order_count,
               count(DISTINCT CASE WHEN i = 2 THEN user_id END) AS repurchase_user_count,
               count(DISTINCT user_id) AS total_user_count, {money('amt', 'i > 1')} AS repurchase_amount,
               {pct('count(DISTINCT CASE WHEN i = 2 THEN user_id END)', 'count(DISTINCT user_id)')} AS repurchase_rate,
               {div('count(*)', 'count(DISTINCT user_id)')} AS avg_repurchase_times
              FROM n GROUP BY sku_id)
        SELECT s.*, sku_name, c3 AS category3_name FROM s LEFT JOIN p USING (sku_id)""",
    )


def _refund_analysis(refunds: str, orders: str = "") -> str:
    return sql(
        "lp",
        f"""
        , f AS (SELECT * FROM lp WHERE rf = 'R' {refunds}),
        t AS (SELECT c3, count(*) AS n FROM f GROUP BY c3 ORDER BY n DESC, c3 LIMIT 1),
        q AS (SELECT ls, count(*) AS n FROM f GROUP BY ls),
        x AS (SELECT count(DISTINCT order_id) AS rc, count(DISTINCT user_id) AS ru, coalesce(sum(amt), 0) AS ra,
                     avg(date_diff('day', day, CAST(l_shipdate AS DATE))) AS days FROM f),
        y AS (SELECT count(*) AS oc, coalesce(sum(amt), 0) AS oa FROM o {orders})
        SELECT rc AS refund_count, ru AS refund_user_count, {dbl('ra')} AS refund_amount,
               round(days, 2) AS avg_refund_days, (SELECT c3 FROM t) AS top_refund_category,
               (SELECT '{{' || string_agg('"' || ls || '":' || n, ',' ORDER BY ls) || '}}' FROM q)
                 AS refund_reason_distribution,
               oc AS order_count, {dbl('oa')} AS order_amount, {pct('rc', 'oc')} AS refund_rate FROM x, y""",
    )


def _top(column: str, n: int | None) -> str:
    limit = f"LIMIT {n}" if n else ""
    return sql(
        "c",
        f"""SELECT {column}, count(*) AS event_count FROM c GROUP BY {column}
            ORDER BY event_count DESC, {column} DESC {limit}""",
    )


def _zip(body: str) -> str:
    return sql(
        "f",
        f"""
        , v AS (SELECT f.*, lag(user_level) OVER (PARTITION BY id ORDER BY dt) AS prev FROM f),
        ch AS (SELECT * FROM v WHERE prev IS NULL OR prev <> user_level)
        {body}""",
    )


def _end(source_order: str = "dt") -> str:
    following = f"lead(dt) OVER (PARTITION BY id ORDER BY {source_order})"
    return f"coalesce(strftime(CAST({following} AS DATE) - 1, '%Y-%m-%d'), '9999-12-31')"


COUPONS = """, cu AS (SELECT 'T' || CAST(tax AS VARCHAR) AS coupon_id, user_id, order_id, date_id, day,
       CASE WHEN ls = 'F' THEN o_orderdate END AS used_time,
       CAST(amt * tax AS DECIMAL(16,2)) AS reduced FROM l WHERE tax > 0)"""
ACTIVITIES = """, ac AS (SELECT 'D' || CAST(disc AS VARCHAR) AS activity_id, user_id, order_id, sku_id, date_id,
       day, CAST(amt * disc AS DECIMAL(16,2)) AS reduced FROM l WHERE disc > 0)"""
TICKETS = """, tk AS (SELECT event_id, user_id, sku_id, date_id, day,
       CASE WHEN value < 20 THEN 'quality' ELSE 'delivery' END AS service_type,
       CASE WHEN value < 5 THEN 'pending' WHEN value < 10 THEN 'processing' WHEN value < 40 THEN 'resolved'
            ELSE 'unsolved' END AS state,
       date_trunc('second', ts) AS created, CAST(floor(value) AS BIGINT) AS mins
       FROM e WHERE event_type = 'error')"""
COUPON_SUMS = f"""count(*) AS get_count, count(DISTINCT user_id) AS get_user_count,
  count(used_time) AS used_count, count(DISTINCT CASE WHEN used_time IS NOT NULL THEN user_id END) AS used_user_count,
  count(DISTINCT CASE WHEN used_time IS NOT NULL THEN order_id END) AS order_count,
  {money('reduced', 'used_time IS NOT NULL')} AS coupon_amount,
  'coupon ' || coupon_id AS coupon_name, 'cash' AS coupon_type"""

ORACLE: dict[str, str] = {
    # Dimensions
    "dim_user_init": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS user_level,
        '2000-12-30' AS start_date, '9999-12-31' AS end_date FROM customer WHERE c_custkey IS NOT NULL""",
    "dim_user_zip_update": _zip(
        f"SELECT id, user_level, dt AS start_date, {_end()} AS end_date FROM ch"
    ),
    "dim_user_scd2": sql(
        "f",
        f"""SELECT id, user_level, dt AS start_date, {_end()} AS end_date,
            CASE WHEN lead(dt) OVER (PARTITION BY id ORDER BY dt) IS NULL THEN '1' ELSE '0' END AS is_current
            FROM f""",
    ),
    "dim_user_scd3": _zip(
        """SELECT id, arg_max(user_level, dt) AS user_level, arg_max(coalesce(prev, ''), dt) AS p,
                  count(*) AS version, max(dt) AS update_time FROM ch GROUP BY id"""
    ).replace(
        "SELECT id, arg_max(user_level, dt)",
        "SELECT id, user_level, nullif(p, '') AS user_level_last, version, update_time FROM (SELECT id, arg_max(user_level, dt)",
    )
    + ")",
    "dim_user_snapshot": sql(
        "f",
        f"""SELECT id, arg_max(user_level, dt) AS user_level, '{FEED_DAYS[-1]}' AS snapshot_date
            FROM f GROUP BY id""",
    ),
    "dim_user_scd1": sql(
        "f",
        """SELECT id, arg_max(user_level, dt) AS user_level,
                  repeat('*', length(any_value(c_name)) - 4) || right(any_value(c_name), 4) AS name_masked
           FROM f JOIN customer ON c_custkey = id GROUP BY id""",
    ),
    "dim_sku": sql(
        "p",
        f"""SELECT sku_id AS id, sku_name, {dbl('price')} AS price, tm_id, c3 AS category3_id FROM p""",
    ),
    "dim_sku_full": sql(
        "p",
        """SELECT sku_id, sku_name, tm_id AS tm_name, c3 AS category3_name, c2 AS category2_name,
                  'ALL' AS category1_name FROM p""",
    ),
    "dim_province": f"""SELECT {big('n_nationkey')} AS id, n_name AS name, {big('n_regionkey')} AS region_id,
        r_name AS region_name, 'ordinary' AS province_type
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_time": """
        WITH b AS (SELECT min(d) AS lo, max(d) AS hi FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events)),
        cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
        SELECT strftime(d, '%Y-%m-%d') AS date_id, year(d) AS "year", quarter(d) AS "quarter",
               month(d) AS "month", day(d) AS "day", weekofyear(d) AS week_of_year, isodow(d) AS week_day,
               (month(d) - 1) % 3 + 1 AS month_of_quarter,
               CASE WHEN month(d) IN (3, 4, 5) THEN 'spring' WHEN month(d) IN (6, 7, 8) THEN 'summer'
                    WHEN month(d) IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END AS season_name,
               CASE WHEN isodow(d) <= 5 THEN '1' ELSE '0' END AS is_workday
        FROM cal""",
    "dim_trademark": "SELECT DISTINCT p_brand AS tm_id, p_brand AS tm_name FROM part",
    "dim_brand": "SELECT DISTINCT p_brand AS tm_id, p_brand AS tm_name FROM part",
    "dim_category1": "SELECT DISTINCT 'ALL' AS category1_id, 'ALL' AS category1_name FROM part",
    "dim_category2": """SELECT DISTINCT p_type AS category2_id, p_type AS category2_name,
        'ALL' AS category1_id FROM part""",
    "dim_category3": sql(
        "p", "SELECT DISTINCT c3 AS category3_id, c3 AS category3_name, c2 AS category2_id FROM p"
    ),
    "dim_spu": sql(
        "p", "SELECT sku_id AS spu_id, sku_name AS spu_name, tm_id, c3 AS category3_id FROM p"
    ),
    "dim_payment_type": """SELECT DISTINCT
        CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '2' WHEN '3-MEDIUM' THEN '3'
             ELSE o_orderpriority END AS payment_type_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'ONLINE' WHEN '2-HIGH' THEN 'OFFLINE'
             WHEN '3-MEDIUM' THEN 'COUPON' ELSE 'UNKNOWN' END AS payment_type_name FROM orders""",
    "dim_activity": sql(
        "l",
        ACTIVITIES
        + """ SELECT activity_id, 'discount ' || activity_id AS activity_name, 'reduction' AS activity_type,
              min(date_id) AS start_time, max(date_id) AS end_time, min(date_id) AS create_time
              FROM ac GROUP BY activity_id""",
    ),
    "dim_coupon": sql(
        "l",
        COUPONS
        + """ SELECT coupon_id, 'coupon ' || coupon_id AS coupon_name, 'cash' AS coupon_type,
              CAST(0 AS DOUBLE) AS coupon_amount, CAST(0 AS DOUBLE) AS condition_amount,
              min(date_id) AS start_time, max(date_id) AS end_time, min(date_id) AS create_time
              FROM cu GROUP BY coupon_id""",
    ),
    "order_accumulating_snapshot": sql(
        "o",
        f"""
        , d(d1, d2) AS (VALUES (DATE '{SNAPSHOT_DAYS[0]}', DATE '{SNAPSHOT_DAYS[1]}'))
        SELECT id AS order_id, user_id, {dbl('amt')} AS total_amount, status AS order_status,
               date_id AS create_time,
               CASE WHEN status = 'PAID' THEN strftime(CASE WHEN day + 30 <= d1 THEN d1 ELSE d2 END, '%Y-%m-%d')
                    END AS pay_time,
               CAST(NULL AS VARCHAR) AS ship_time,
               CASE WHEN status = 'COMPLETED'
                    THEN strftime(CASE WHEN day + 30 <= d1 THEN d1 ELSE d2 END, '%Y-%m-%d') END AS finish_time,
               CAST(NULL AS VARCHAR) AS refund_time, '{SNAPSHOT_DAYS[1]}' AS snapshot_date
        FROM o, d""",
    ),
    # Detail facts
    "dwd_order_detail": sql(
        "lp",
        f"""SELECT order_id, user_id, sku_id, sku_name, tm_id AS tm_name, c3 AS category3_name,
            num AS sku_num, {dbl('amt')} AS order_amount FROM lp WHERE num > 0 AND amt >= 0""",
    ),
    "dwd_order_detail_daily": sql(
        "l",
        f"""SELECT order_id * 10 + l_linenumber AS id, order_id, user_id, {big('c_nationkey')} AS province_id,
            sku_id, num AS sku_num, {dbl('amt')} AS original_amount, CAST(0 AS DOUBLE) AS activity_reduce,
            CAST(0 AS DOUBLE) AS coupon_reduce, {dbl('amt')} AS final_amount, date_id
            FROM l LEFT JOIN customer ON user_id = c_custkey""",
    ),
    "dwd_order_info": sql(
        "op",
        f"""SELECT id, user_id, status AS order_status_name,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'ONLINE' WHEN '2-HIGH' THEN 'OFFLINE'
                 WHEN '3-MEDIUM' THEN 'COUPON' ELSE 'UNKNOWN' END AS payment_way_name,
            coalesce(c_mktsegment, 'UNKNOWN') AS user_level, coalesce(province_name, 'UNKNOWN') AS province_name,
            {dbl('amt')} AS total_amount, {dbl('goods')} AS goods_amount, {big('paid')} AS is_paid, date_id
            FROM op LEFT JOIN customer ON user_id = c_custkey""",
    ),
    "dwd_order_info_daily": f"""SELECT o_orderkey AS id, o_custkey AS user_id,
        {big('c_nationkey')} AS province_id,
        CASE o_orderstatus WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' WHEN 'F' THEN '1004' END AS order_status,
        o_totalprice AS total_amount,
        CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '2' WHEN '3-MEDIUM' THEN '3'
             ELSE o_orderpriority END AS payment_way,
        strftime(o_orderdate, '%Y-%m-%d') AS date_id
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "dwd_payment_info": sql(
        "op",
        f"""SELECT id AS order_id, user_id, {dbl('amt')} AS total_amount, status AS payment_status,
            {big('province_id')} AS province_id, date_id FROM op WHERE paid = 1""",
    ),
    "dwd_action": sql(
        "a p",
        """SELECT user_id, a.sku_id, CASE WHEN code <> 'page_view' THEN CAST(event_id AS VARCHAR) END AS action_id,
           code AS action_code,
           CASE code WHEN 'page_view' THEN '页面浏览' WHEN 'favor_add' THEN '收藏商品'
                WHEN 'cart_add' THEN '加购物车' ELSE '下单' END AS action_name,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
           CAST(CASE WHEN code IN ('page_view', 'order') THEN event_id ELSE a.sku_id END AS VARCHAR) AS action_target_id,
           CASE code WHEN 'page_view' THEN 'page' WHEN 'order' THEN 'order' ELSE 'sku' END AS action_target_type,
           tm_id AS tm_name, c3 AS category3_name, date_id
           FROM a LEFT JOIN p ON a.sku_id = p.sku_id WHERE user_id IS NOT NULL""",
    ),
    "dwd_order_refund": sql(
        "rl p",
        f"""SELECT order_id, user_id, sku_id, num AS refund_num, {dbl('amt')} AS refund_amount,
            {big('c_nationkey')} AS province_id, c3 AS category3_name, tm_id AS tm_name, date_id
            FROM rl LEFT JOIN p USING (sku_id) LEFT JOIN customer ON user_id = c_custkey""",
    ),
    "dwd_review_info": sql(
        "e p",
        """SELECT event_id AS review_id, user_id, e.sku_id,
           CAST(least(5, floor(value / 10) + 1) AS BIGINT) AS review_star, c3 AS category3_name, tm_id AS tm_name
           FROM e LEFT JOIN p ON e.sku_id = p.sku_id WHERE event_type = 'signup' AND user_id IS NOT NULL""",
    ),
    "dwd_order_status_log": sql(
        "o",
        """SELECT id, id AS order_id, status AS order_status, user_id AS operate_user_id, date_id FROM o""",
    ),
    "dwd_sku_info": sql(
        "p",
        f"""SELECT sku_id AS id, sku_name, {dbl('price')} AS price, tm_id, tm_id AS tm_name, c3 AS category3_id,
            c3 AS category3_name, c2 AS category2_id, c2 AS category2_name, 'ALL' AS category1_id,
            'ALL' AS category1_name FROM p""",
    ),
    "dwd_coupon_info": sql(
        "l",
        COUPONS
        + """ SELECT coupon_id AS id, 'coupon ' || coupon_id AS coupon_name, 'cash' AS coupon_type,
              CAST(0 AS DOUBLE) AS discount_amount, CAST(0 AS DOUBLE) AS threshold_amount,
              min(date_id) AS start_time, max(date_id) AS end_time, min(date_id) AS create_time
              FROM cu GROUP BY coupon_id""",
    ),
    "dwd_coupon_use": sql(
        "l",
        COUPONS
        + f""" SELECT order_id AS id, coupon_id, user_id, order_id, date_id || ' 00:00:00' AS get_time,
              strftime(used_time, '%Y-%m-%d %H:%M:%S') AS used_time, {dbl('reduced')} AS reduce_amount, date_id
              FROM cu""",
    ),
    "dwd_activity_info": sql(
        "l",
        ACTIVITIES
        + """ SELECT activity_id AS id, 'discount ' || activity_id AS activity_name, 'reduction' AS activity_type,
              min(date_id) AS start_time, max(date_id) AS end_time, min(date_id) AS create_time
              FROM ac GROUP BY activity_id""",
    ),
    "dwd_activity_order": sql(
        "l",
        ACTIVITIES
        + f""" SELECT order_id AS id, activity_id, order_id, user_id, sku_id, {dbl('reduced')} AS reduce_amount,
              date_id FROM ac""",
    ),
    "dwd_comment_info": sql(
        "e",
        """SELECT event_id AS id, user_id, sku_id,
           CAST(least(5, floor(value / 10) + 1) AS BIGINT) AS appraisal_star,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, date_id FROM e WHERE event_type = 'signup'""",
    ),
    "dwd_favor_info": sql(
        "e",
        """SELECT event_id AS id, user_id, sku_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, date_id
           FROM e WHERE event_type = 'signup'""",
    ),
    "dwd_cart_info": sql(
        "e",
        """SELECT event_id AS id, user_id, sku_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, date_id,
           CASE WHEN EXISTS (SELECT 1 FROM e b WHERE b.event_type = 'purchase' AND b.user_id = e.user_id
                             AND b.sku_id = e.sku_id) THEN '1' ELSE '0' END AS is_ordered
           FROM e WHERE event_type = 'click'""",
    ),
    "dwd_customer_service": sql(
        "e",
        TICKETS
        + """ SELECT event_id AS id, user_id, sku_id, service_type,
              strftime(created, '%Y-%m-%d %H:%M:%S') AS create_time,
              CASE WHEN state IN ('resolved', 'unsolved')
                   THEN strftime(created + to_minutes(mins), '%Y-%m-%d %H:%M:%S') END AS handle_time,
              state AS handle_result, date_id FROM tk""",
    ),
    "order_dedup_latest": f"""SELECT l_orderkey AS order_id, {big('l_linenumber')} AS line_number, l_partkey AS sku_id,
        l_extendedprice AS amount, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship_time
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC) = 1""",
    # Daily aggregates
    "dws_gmv_stats": sql(
        "o",
        f"""SELECT date_id, {ORDER_SUMS}, {money('goods')} AS goods_amount, {FREIGHT},
            count(*) FILTER (WHERE status = 'PAID') AS paid_order_count,
            {money('amt', "status = 'PAID'")} AS paid_gmv,
            count(*) FILTER (WHERE status = 'COMPLETED') AS completed_order_count,
            {money('amt', "status = 'COMPLETED'")} AS completed_gmv
            FROM o GROUP BY date_id""",
    ),
    "dws_user_action_stats": sql(
        "a",
        """SELECT user_id, sku_id, date_id, count(*) FILTER (WHERE code = 'page_view') AS page_view_count,
           count(*) FILTER (WHERE code = 'cart_add') AS cart_add_count,
           count(*) FILTER (WHERE code = 'favor_add') AS favor_add_count,
           count(*) FILTER (WHERE code = 'order') AS order_count FROM a GROUP BY ALL""",
    ),
    "dws_user_action_order_stats": sql(
        "a l rl",
        f"""
        , u AS (
          SELECT user_id, sku_id, date_id, code, NULL AS order_id, NULL AS amt, 0 AS paid, NULL AS back FROM a
          UNION ALL SELECT user_id, sku_id, date_id, 'line', order_id, amt, paid, NULL FROM l
          UNION ALL SELECT user_id, sku_id, date_id, 'back', NULL, NULL, 0, amt FROM rl)
        SELECT user_id, sku_id, date_id, count(*) FILTER (WHERE code = 'page_view') AS page_view_count,
          count(*) FILTER (WHERE code = 'cart_add') AS cart_add_count,
          count(*) FILTER (WHERE code = 'favor_add') AS favor_add_count,
          count(DISTINCT order_id) AS order_count, {money('amt')} AS order_amount,
          count(DISTINCT CASE WHEN paid = 1 THEN order_id END) AS payment_count,
          {money('amt', 'paid = 1')} AS payment_amount,
          count(back) AS refund_count, {money('back')} AS refund_amount
        FROM u GROUP BY user_id, sku_id, date_id""",
    ),
    "dws_sku_stats": sql(
        "lr p",
        f"""
        , m AS ({_line_measures('sku_id, date_id', 'lr')})
        SELECT m.sku_id, date_id, order_count, order_num, {dbl('order_amt')} AS order_amount, payment_count,
               payment_num, {dbl('payment_amt')} AS payment_amount, refund_count, refund_num,
               {dbl('refund_amt')} AS refund_amount, tm_id, c3 AS category3_id
        FROM m LEFT JOIN p ON m.sku_id = p.sku_id""",
    ),
    "dws_user_stats": sql(
        "l a",
        FAVORITE_PERIOD
        + f""", g AS (SELECT user_id, count(*) AS n FROM l WHERE day <= {BO} GROUP BY 1)
        SELECT o.user_id, c_mktsegment AS user_level, count(DISTINCT o.id) AS order_count,
               {money('amt')} AS order_amount, {div('sum(amt)', 'count(*)')} AS avg_order_amount,
               count(*) FILTER (WHERE paid = 1) AS paid_order_count, {money('amt', 'paid = 1')} AS paid_amount,
               coalesce(any_value(g.n), 0) AS goods_num, min(date_id) AS first_order_date,
               max(date_id) AS last_order_date, {big(f"{BO} - max(day)")} AS days_since_last_order,
               strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first_order_time,
               strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_order_time,
               any_value(fp.favorite_period) AS favorite_period
        FROM o LEFT JOIN fp ON fp.user_id = o.user_id LEFT JOIN customer ON o.user_id = c_custkey LEFT JOIN g ON g.user_id = o.user_id
        WHERE day <= {BO} GROUP BY o.user_id, c_mktsegment""",
    ),
    "user_favorite_period": sql("a", FAVORITE_PERIOD + " SELECT * FROM fp"),
    "dws_province_stats": sql(
        "op",
        f"""SELECT {BIG_PROVINCE}, date_id, {ORDER_SUMS}, {money('goods')} AS goods_amount, {FREIGHT}
            FROM op GROUP BY {PROVINCE}, date_id""",
    ),
    "dws_trademark_stats": sql(
        "lp",
        f"""SELECT tm_id, date_id, count(DISTINCT order_id) AS order_count, {big('sum(num)')} AS sale_num,
            {money('amt')} AS sale_amount, {div('sum(amt)', 'sum(num)')} AS avg_price FROM lp GROUP BY ALL""",
    ),
    "dws_category_stats": sql(
        "lp",
        f"""SELECT 'ALL' AS category1_id, c2 AS category2_id, c3 AS category3_id, date_id,
            count(DISTINCT order_id) AS order_count, {big('sum(num)')} AS sale_num,
            {money('amt')} AS sale_amount, {div('sum(amt)', 'sum(num)')} AS avg_price
            FROM lp GROUP BY c2, c3, date_id""",
    ),
    "dws_order_day": sql(
        "l rl",
        COUPONS
        + ACTIVITIES
        + f"""
        , od AS (SELECT date_id, count(DISTINCT id) AS order_count, count(DISTINCT user_id) AS order_user_count,
                        {money('amt')} AS order_amount, {PAYMENT_SUMS} FROM o GROUP BY date_id),
        rd AS (SELECT date_id, count(DISTINCT order_id) AS refund_count, {money('amt')} AS refund_amount
               FROM rl GROUP BY date_id),
        cd AS (SELECT date_id, count(DISTINCT order_id) AS coupon_count, {money('reduced')} AS coupon_amount
               FROM cu WHERE used_time IS NOT NULL GROUP BY date_id),
        ad AS (SELECT date_id, count(DISTINCT order_id) AS activity_count, {money('reduced')} AS activity_amount
               FROM ac GROUP BY date_id)
        SELECT date_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ORDER_DAY_SUMS)}, coalesce(refund_count, 0) AS refund_count, coalesce(refund_amount, 0) AS refund_amount,
               coalesce(coupon_count, 0) AS coupon_count, coalesce(coupon_amount, 0) AS coupon_amount,
               coalesce(activity_count, 0) AS activity_count, coalesce(activity_amount, 0) AS activity_amount
        FROM od FULL JOIN rd USING (date_id) LEFT JOIN cd USING (date_id) LEFT JOIN ad USING (date_id)""",
    ),
    "dws_user_day": sql(
        "o a",
        f"""
        , u AS (SELECT user_id, date_id, 'o' AS what, amt, paid FROM o
                UNION ALL SELECT user_id, date_id, code, NULL, 0 FROM a)
        SELECT user_id, date_id, count(*) FILTER (WHERE what = 'o') AS order_count,
            {money('amt')} AS order_amount,
            count(*) FILTER (WHERE what = 'o' AND paid = 1) AS payment_count,
            {money('amt', 'paid = 1')} AS payment_amount,
            count(*) FILTER (WHERE what = 'cart_add') AS cart_count,
            count(*) FILTER (WHERE what = 'favor_add') AS favor_count,
            count(*) FILTER (WHERE what = 'favor_add') AS comment_count
            FROM u GROUP BY user_id, date_id""",
    ),
    "dws_sku_day": sql(
        "lr a",
        f"""
        , m AS ({_line_measures('sku_id, date_id', 'lr')}),
        i AS (SELECT sku_id, date_id, count(*) FILTER (WHERE code = 'cart_add') AS cart_count,
                     count(*) FILTER (WHERE code = 'favor_add') AS favor_count FROM a GROUP BY 1, 2)
        SELECT sku_id, date_id, coalesce(order_count, 0) AS order_count, coalesce(order_num, 0) AS order_num,
               coalesce({dbl('order_amt')}, 0) AS order_amount, coalesce(payment_count, 0) AS payment_count,
               coalesce(payment_num, 0) AS payment_num, coalesce({dbl('payment_amt')}, 0) AS payment_amount,
               coalesce(refund_count, 0) AS refund_count, coalesce(refund_num, 0) AS refund_num,
               coalesce({dbl('refund_amt')}, 0) AS refund_amount, coalesce(cart_count, 0) AS cart_count,
               coalesce(favor_count, 0) AS favor_count
        FROM m FULL JOIN i USING (sku_id, date_id)""",
    ),
    "dws_order_week": _rollup("week", "date_trunc('week', day)", "date_trunc('week', day) + INTERVAL 6 DAY"),
    "dws_order_month": _rollup("month", "date_trunc('month', day)", "last_day(day)"),
    "dws_user_new_day": sql(
        "o",
        """
        , n AS (SELECT user_id, min(date_id) AS date_id FROM o GROUP BY 1)
        SELECT n.user_id, date_id, c_mktsegment AS user_level FROM n LEFT JOIN customer ON user_id = c_custkey""",
    ),
    "dws_user_retention_day": sql(
        "a",
        f"""
        , d AS (SELECT DISTINCT user_id, day FROM a),
        first AS (SELECT user_id, min(day) AS cohort FROM d GROUP BY 1)
        SELECT d.user_id, strftime(cohort, '%Y-%m-%d') AS cohort_day, {big('day - cohort')} AS retention_day,
               strftime(day, '%Y-%m-%d') AS retention_date
        FROM d JOIN first USING (user_id) WHERE day - cohort IN (1, 3, 7)""",
    ),
    "dws_trademark_day": sql(
        "lp",
        f"""
        , m AS ({_line_measures('tm_id, date_id', 'lp')})
        SELECT tm_id, date_id, order_count, order_num, {dbl('order_amt')} AS order_amount, payment_count,
               payment_num, {dbl('payment_amt')} AS payment_amount FROM m""",
    ),
    "dws_category3_day": sql(
        "lp",
        f"""
        , m AS ({_line_measures('c2, c3, date_id', 'lp')})
        SELECT 'ALL' AS category1_id, c2 AS category2_id, c3 AS category3_id, date_id, order_count, order_num,
               {dbl('order_amt')} AS order_amount, payment_count, payment_num,
               {dbl('payment_amt')} AS payment_amount FROM m""",
    ),
    "dws_province_day": sql(
        "op",
        f"""SELECT {BIG_PROVINCE}, date_id, count(DISTINCT id) AS order_count,
            count(DISTINCT user_id) AS order_user_count, {money('amt')} AS order_amount, {PAYMENT_SUMS}
            FROM op GROUP BY {PROVINCE}, date_id""",
    ),
    "dws_coupon_day": sql(
        "l", COUPONS + f" SELECT coupon_id, date_id, {COUPON_SUMS} FROM cu GROUP BY coupon_id, date_id"
    ),
    "dws_activity_day": sql(
        "l",
        ACTIVITIES
        + f""" SELECT activity_id, date_id, count(DISTINCT order_id) AS order_count,
              count(DISTINCT user_id) AS order_user_count, {money('reduced')} AS reduce_amount,
              'discount ' || activity_id AS activity_name, 'reduction' AS activity_type
              FROM ac GROUP BY activity_id, date_id""",
    ),
    "dws_customer_service_day": sql(
        "e",
        TICKETS
        + f""" SELECT date_id, service_type, count(*) AS total_count,
              count(*) FILTER (WHERE state = 'pending') AS pending_count,
              count(*) FILTER (WHERE state = 'resolved') AS resolved_count,
              {pct("count(*) FILTER (WHERE state = 'resolved')", 'count(*)')} AS resolved_rate
              FROM tk GROUP BY date_id, service_type""",
    ),
    "dws_page_view_day": sql(
        "e",
        f"""
        , g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                       <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM e WHERE event_type = 'view'),
        n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, opens DESC
                     ROWS UNBOUNDED PRECEDING) AS sid FROM g),
        s AS (SELECT user_id, sid, min(ts) AS t0, epoch_us(max(ts)) - epoch_us(min(ts)) AS us, count(*) AS views
              FROM n GROUP BY user_id, sid)
        SELECT strftime(t0, '%Y-%m-%d') AS date_id, hour(t0) AS hour_id, {big('sum(views)')} AS view_count,
               count(DISTINCT user_id) AS visitor_count, count(*) AS session_count,
               CAST(floor(sum(us) / (count(*) * 1000000)) AS BIGINT) AS avg_duration_sec,
               {pct('count(*) FILTER (WHERE views = 1)', 'count(*)')} AS bounce_rate
        FROM s GROUP BY 1, 2""",
    ),
    # Reports
    "ads_gmv_day": sql(
        "rl r",
        f"""
        , w AS (SELECT k, o.* FROM o JOIN r ON day > {BO} - k AND day <= {BO}),
        days AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, date_id, user_id FROM w) GROUP BY k),
        ref AS (SELECT k, count(DISTINCT order_id) AS n, sum(amt) AS amt
                FROM rl JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY k)
        SELECT {big('w.k')} AS recent_days, {ORDER_SUMS.replace('amt', 'w.amt').replace('id)', 'id)')},
               {big('any_value(days.n)')} AS order_user_days, {money('w.goods')} AS goods_amount, {FREIGHT},
               {PAYMENT_SUMS.replace('amt', 'w.amt')}, {money('w.amt', "status = 'COMPLETED'")} AS completed_amount,
               count(*) FILTER (WHERE status = 'COMPLETED') AS completed_count,
               {div('sum(w.amt) FILTER (WHERE paid = 1)', 'count(*) FILTER (WHERE paid = 1)')} AS avg_pay_amount,
               coalesce({dbl('any_value(ref.amt)')}, 0) AS refund_amount,
               coalesce(any_value(ref.n), 0) AS refund_count,
               CAST(coalesce(sum(w.amt) FILTER (WHERE paid = 1), 0) - coalesce(any_value(ref.amt), 0) AS DOUBLE)
                 AS net_sales_amount
        FROM w JOIN days USING (k) LEFT JOIN ref USING (k) GROUP BY w.k""",
    ),
    "ads_user_retention": _cohort_long("a", BE, "(1), (7), (14), (30)", 30),
    "ads_user_retention_orders": _cohort_long("o", BO, "(1), (7), (14), (30)", None),
    "ads_user_retention_detail": sql(
        "a",
        f"""
        , d AS (SELECT DISTINCT user_id, day FROM a WHERE day <= {BE}),
        x AS (SELECT user_id, day, min(day) OVER (PARTITION BY user_id) AS cohort FROM d)
        SELECT strftime(cohort, '%Y-%m-%d') AS cohort_day, count(DISTINCT user_id) AS total_new_users,
               {', '.join(_detail_cell(k) for k in (1, 3, 7, 14, 30))}
        FROM x WHERE cohort >= {BE} - 90 GROUP BY cohort""",
    ),
    "ads_sku_sales_rank": sql(
        "lrp r",
        f"""
        , m AS ({_line_measures('sku_id, sku_name, tm_id, c3', 'lrp', BO)})
        SELECT {big('k')} AS recent_days, sku_id, sku_name, tm_id AS tm_name, c3 AS category3_name, order_count, order_num, {dbl('order_amt')} AS order_amount,
               payment_count, payment_num, {dbl('payment_amt')} AS payment_amount, refund_count, refund_num,
               {dbl('refund_amt')} AS refund_amount,
               row_number() OVER (PARTITION BY k ORDER BY order_amt DESC, sku_id) AS "rank",
               row_number() OVER (PARTITION BY k ORDER BY order_num DESC, sku_id) AS sales_rank
        FROM m WHERE order_count > 0""",
    ),
    "ads_sku_sales_rank_top100": sql(
        "l p",
        f"""
        , m AS (SELECT sku_id, count(DISTINCT order_id) AS order_count, sum(amt) AS amt
                FROM l WHERE day > {BO} - 7 AND day <= {BO} GROUP BY sku_id)
        SELECT m.sku_id, sku_name, order_count, {dbl('amt')} AS order_amount,
               row_number() OVER (ORDER BY amt DESC, m.sku_id) AS "rank"
        FROM m LEFT JOIN p ON m.sku_id = p.sku_id ORDER BY "rank" LIMIT 100""",
    ),
    "ads_conversion_rate": sql(
        "a r",
        f"""
        , s AS (SELECT k, count(*) FILTER (WHERE code = 'page_view') AS v,
                       count(*) FILTER (WHERE code = 'cart_add') AS c, count(*) FILTER (WHERE code = 'order') AS o,
                       count(*) FILTER (WHERE paid = 1) AS p
                FROM a JOIN r ON day > {BE} - k AND day <= {BE} GROUP BY k)
        SELECT {big('k')} AS recent_days, v AS visit_count, c AS cart_count, o AS order_count, p AS payment_count,
               {pct('c', 'v')} AS visit_to_cart_rate, {pct('o', 'c')} AS cart_to_order_rate,
               {pct('p', 'o')} AS order_to_payment_rate, {pct('p', 'v')} AS total_conversion_rate FROM s""",
    ),
    "ads_conversion_funnel": sql(
        "a r",
        f"""
        , s AS (SELECT k, count(DISTINCT CASE WHEN code = 'page_view' THEN user_id END) AS s1,
                       count(DISTINCT CASE WHEN code = 'favor_add' THEN user_id END) AS s2,
                       count(DISTINCT CASE WHEN code = 'cart_add' THEN user_id END) AS s3,
                       count(DISTINCT CASE WHEN code = 'order' THEN user_id END) AS s4,
                       count(DISTINCT CASE WHEN paid = 1 THEN user_id END) AS s5
                FROM a JOIN r ON day > {BE} - k AND day <= {BE} GROUP BY k)
        SELECT {big('k')} AS recent_days, 'page_view' AS step1_name, s1 AS step1_count, 'favor_add' AS step2_name,
               s2 AS step2_count, 'cart_add' AS step3_name, s3 AS step3_count, 'order' AS step4_name,
               s4 AS step4_count, 'payment' AS step5_name, s5 AS step5_count,
               {pct('s2', 's1')} AS step1_to_step2_rate, {pct('s3', 's2')} AS step2_to_step3_rate,
               {pct('s4', 's3')} AS step3_to_step4_rate, {pct('s5', 's4')} AS step4_to_step5_rate,
               {pct('s5', 's1')} AS total_conversion_rate FROM s""",
    ),
    "ads_user_repurchase_rate": sql(
        "o r",
        f"""
        , u AS (SELECT k, user_id, count(DISTINCT id) AS n FROM o JOIN r ON day > {BO} - k AND day <= {BO}
                WHERE k IN (7, 30) GROUP BY k, user_id)
        SELECT {big('k')} AS recent_days, count(*) AS total_user_count,
               count(*) FILTER (WHERE n >= 2) AS repeat_user_count,
               {pct('count(*) FILTER (WHERE n >= 2)', 'count(*)')} AS repurchase_rate,
               {div('sum(n)', 'count(*)')} AS avg_order_per_user, max(n) AS max_order_per_user
        FROM u GROUP BY k""",
    ),
    "ads_user_activity": sql(
        "a",
        f"""
        , s AS (SELECT count(DISTINCT CASE WHEN day = {BE} THEN user_id END) AS dau,
                       count(DISTINCT CASE WHEN day >= {BE} - 6 THEN user_id END) AS wau,
                       count(DISTINCT user_id) AS mau FROM a WHERE day >= {BE} - 29 AND day <= {BE})
        SELECT dau, wau, mau, {pct('dau', 'mau')} AS dau_to_mau_rate, {pct('wau', 'mau')} AS wau_to_mau_rate
        FROM s""",
    ),
    "ads_user_active_day": sql(
        "a r",
        f"""
        , s AS (SELECT count(DISTINCT CASE WHEN day = {BE} THEN user_id END) AS dau,
                       count(DISTINCT CASE WHEN day >= {BE} - 6 THEN user_id END) AS wau,
                       count(DISTINCT user_id) AS mau FROM a WHERE day >= {BE} - 29 AND day <= {BE})
        SELECT {big('k')} AS recent_days, dau, wau, mau FROM s, r""",
    ),
    "ads_category_sale_analysis": sql(
        "lrp r",
        f"""
        , m AS ({_line_measures('c2', 'lrp', BO)})
        SELECT {big('k')} AS recent_days, 'ALL' AS category1_id, c2 AS category2_id, order_count,
               order_num AS sale_num, {dbl('order_amt')} AS sale_amount, {div('order_amt', 'order_num')} AS avg_price,
               payment_count, {dbl('payment_amt')} AS payment_amount, refund_count,
               {dbl('refund_amt')} AS refund_amount, {pct('payment_amt', 'order_amt')} AS payment_rate,
               {pct('refund_amt', 'payment_amt')} AS refund_rate FROM m""",
    ),
    "ads_province_sale": sql(
        "op r",
        f"""
        , m AS (SELECT k, {PROVINCE}, count(DISTINCT id) AS oc, count(DISTINCT user_id) AS uc, sum(amt) AS amt, sum(cut) AS cut
                FROM op JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY ALL)
        SELECT {big('k')} AS recent_days, {BIG_PROVINCE}, oc AS order_count, uc AS order_user_count,
               {dbl('amt')} AS gmv, {div('amt', 'oc')} AS avg_order_amount, {dbl('cut')} AS discount_amount,
               row_number() OVER (PARTITION BY k ORDER BY amt DESC, m.province_id) AS "rank" FROM m""",
    ),
    "ads_gmv_trend": sql(
        "o",
        f"""
        , d AS (SELECT date_id, sum(amt) AS amt, count(DISTINCT id) AS n, count(DISTINCT user_id) AS u
                FROM o GROUP BY date_id),
        x AS (SELECT b.date_id, c.amt, c.n, c.u, d1.amt AS amt1, d1.n AS n1, y.amt AS amty, y.n AS ny
              FROM (SELECT '{ORDER_DAY}' AS date_id) b LEFT JOIN d c ON c.date_id = b.date_id
                   LEFT JOIN d d1 ON d1.date_id = '2000-12-30' LEFT JOIN d y ON y.date_id = '1999-12-31')
        SELECT date_id, {dbl('amt')} AS gmv, n AS order_count, u AS order_user_count,
               {div('amt', 'n')} AS avg_order_amount, {growth('amt', 'amt1')} AS gmv_dod_rate,
               {growth('amt', 'amty')} AS gmv_yoy_rate, {growth('n', 'n1')} AS order_count_dod_rate,
               {growth('n', 'ny')} AS order_count_yoy_rate FROM x""",
    ),
    "ads_gmv_trend_series": sql(
        "o",
        f"""
        , d AS (SELECT day, date_id, sum(amt) AS amt FROM o GROUP BY day, date_id)
        SELECT c.date_id, {dbl('c.amt')} AS gmv, {dbl('b.amt')} AS prev_gmv,
               {growth('c.amt', 'b.amt')} AS gmv_dod_rate
        FROM d c LEFT JOIN d b ON b.day = c.day - 1""",
    ),
    "ads_sku_repurchase_analysis": _repurchase(""),
    "ads_sku_repurchase_recent": _repurchase(f"WHERE day > {BO} - 31 AND day <= {BO}"),
    "ads_refund_analysis": _refund_analysis(""),
    "ads_refund_analysis_day": _refund_analysis(f"AND CAST(l_shipdate AS DATE) = {BO}", f"WHERE day = {BO}"),
    "ads_dashboard": sql(
        "a p",
        f"""
        , t AS (SELECT a.*, p.c2, hour(ts) AS h FROM a LEFT JOIN p ON a.sku_id = p.sku_id
                WHERE day = {BE} AND hour(ts) <= 23),
        b AS (SELECT * FROM t WHERE code = 'order')
        SELECT '{EVENT_DAY}' AS date_id, CAST(23 AS BIGINT) AS "hour",
          (SELECT {money('amt')} FROM b WHERE h = 23) AS current_gmv, (SELECT {money('amt')} FROM b) AS today_gmv,
          (SELECT count(*) FROM b WHERE h = 23) AS current_order_count, (SELECT count(*) FROM b) AS today_order_count,
          (SELECT count(DISTINCT user_id) FROM b WHERE h = 23) AS current_user_count,
          (SELECT count(DISTINCT user_id) FROM b) AS today_user_count,
          (SELECT {pct("count(*) FILTER (WHERE code = 'order')", "count(*) FILTER (WHERE code = 'page_view')")}
             FROM t WHERE h = 23) AS current_conversion_rate,
          (SELECT {pct("count(*) FILTER (WHERE code = 'order')", "count(*) FILTER (WHERE code = 'page_view')")}
             FROM t) AS today_conversion_rate,
          (SELECT h FROM b GROUP BY h ORDER BY count(*) DESC, h LIMIT 1) AS peak_hour,
          (SELECT sku_id FROM b GROUP BY sku_id ORDER BY count(*) DESC, sku_id LIMIT 1) AS hot_sku,
          (SELECT c2 FROM b WHERE c2 IS NOT NULL GROUP BY c2 ORDER BY count(*) DESC, c2 LIMIT 1) AS hot_category,
          CAST(10000000 AS DOUBLE) AS gmv_target,
          (SELECT {pct('coalesce(sum(amt), 0)', '10000000')} FROM b) AS gmv_progress""",
    ),
    "ads_gmv_province": sql(
        "op r",
        f"""
        , m AS (SELECT k, {PROVINCE}, count(DISTINCT id) AS order_count, count(DISTINCT user_id) AS order_user_count,
                       sum(amt) AS amt, coalesce(sum(amt) FILTER (WHERE paid = 1), 0) AS pay
                FROM op JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY ALL)
        SELECT {big('k')} AS recent_days, {BIG_PROVINCE}, {dbl('amt')} AS gmv,
               {div('amt', 'sum(amt) OVER (PARTITION BY k)', 4)} AS gmv_share, order_count, order_user_count,
               {dbl('pay')} AS payment_amount FROM m""",
    ),
    "ads_gmv_trademark": sql(
        "lp r",
        f"""
        , m AS ({_line_measures('tm_id', 'lp', BO)})
        SELECT {big('k')} AS recent_days, tm_id, {dbl('order_amt')} AS gmv,
               {div('order_amt', 'sum(order_amt) OVER (PARTITION BY k)', 4)} AS gmv_share, order_count, order_num,
               {dbl('payment_amt')} AS payment_amount FROM m""",
    ),
    "ads_gmv_category": sql(
        "lp r",
        f"""
        , m AS ({_line_measures('c2, c3', 'lp', BO)})
        SELECT {big('k')} AS recent_days, 'ALL' AS category1_id, c2 AS category2_id, c3 AS category3_id,
               {dbl('order_amt')} AS gmv, {div('order_amt', 'sum(order_amt) OVER (PARTITION BY k)', 4)} AS gmv_share,
               order_count, order_num, {dbl('payment_amt')} AS payment_amount FROM m""",
    ),
    "ads_trademark_stats": sql(
        "lrp r",
        f"""
        , m AS ({_line_measures('tm_id', 'lrp', BO)})
        SELECT {big('k')} AS recent_days, tm_id, order_count, order_num, {dbl('order_amt')} AS order_amount,
               payment_count, payment_num, {dbl('payment_amt')} AS payment_amount, refund_count, refund_num,
               {dbl('refund_amt')} AS refund_amount,
               {div('order_amt', 'sum(order_amt) OVER (PARTITION BY k)', 4)} AS gmv_share,
               row_number() OVER (PARTITION BY k ORDER BY order_amt DESC, tm_id) AS amount_rank FROM m""",
    ),
    "ads_province_stats": sql(
        "op rl r",
        f"""
        , m AS (SELECT k, {PROVINCE}, count(DISTINCT id) AS order_count, count(DISTINCT user_id) AS order_user_count,
                       sum(amt) AS amt, count(*) FILTER (WHERE paid = 1) AS payment_count,
                       coalesce(sum(amt) FILTER (WHERE paid = 1), 0) AS pay
                FROM op JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY ALL),
        x AS (SELECT k, {PROVINCE}, count(DISTINCT order_id) AS n, sum(rl.amt) AS amt
              FROM rl JOIN op ON rl.order_id = op.id JOIN r ON rl.day > {BO} - k AND rl.day <= {BO}
              GROUP BY ALL)
        SELECT {big('k')} AS recent_days, {BIG_PROVINCE}, coalesce(order_count, 0) AS order_count,
               coalesce(order_user_count, 0) AS order_user_count, {dbl('coalesce(m.amt, 0)')} AS order_amount,
               coalesce(payment_count, 0) AS payment_count, {dbl('coalesce(pay, 0)')} AS payment_amount,
               coalesce(x.n, 0) AS refund_count, coalesce({dbl('x.amt')}, 0) AS refund_amount
        FROM m FULL JOIN x USING (k, {PROVINCE})""",
    ),
    "ads_user_new_day": sql(
        "o",
        f"""
        , n AS (SELECT user_id, min(date_id) AS date_id FROM o GROUP BY 1)
        SELECT date_id, count(*) AS new_user_count,
          {', '.join(f"count(*) FILTER (WHERE c_mktsegment = '{g}') AS new_user_level{i}_count"
                     for i, g in enumerate(SEGMENTS, 1))}
        FROM n LEFT JOIN customer ON user_id = c_custkey GROUP BY date_id""",
    ),
    "ads_sku_exposure_click": sql(
        "e",
        f"""
        , s AS (SELECT sku_id, count(*) FILTER (WHERE event_type = 'view') AS v,
                       count(*) FILTER (WHERE event_type = 'click') AS c FROM e GROUP BY sku_id)
        SELECT sku_id, v AS exposure_count, c AS click_count, c AS cart_count, {pct('c', 'v')} AS click_rate,
               {pct('c', 'c')} AS cart_rate FROM s""",
    ),
    "ads_order_stats": sql(
        "a",
        f"""SELECT hour(ts) AS hour_slot, count(*) AS order_count, {money('amt')} AS gmv
            FROM a WHERE code = 'order' GROUP BY 1""",
    ),
    "ads_hot_sku": sql(
        "l",
        f"""
        , m AS (SELECT sku_id, count(DISTINCT order_id) AS order_count, sum(amt) AS amt FROM l GROUP BY sku_id)
        SELECT sku_id, order_count, {dbl('amt')} AS total_gmv,
               row_number() OVER (ORDER BY amt DESC, sku_id) AS "rank" FROM m ORDER BY "rank" LIMIT 10""",
    ),
    "ads_dau_by_device": sql(
        "e",
        f"""
        , s AS (SELECT user_id, min(ts) AS first_seen, max(ts) FILTER (WHERE ts < {BE}) AS last_seen FROM e GROUP BY 1),
        d AS (SELECT user_id, CASE WHEN value < 10 THEN 'PC' WHEN value < 25 THEN 'MOBILE' ELSE 'APP' END AS dev,
                     count(*) AS pv, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000) AS dur
              FROM e WHERE day = {BE} GROUP BY ALL)
        SELECT dev AS device_type, count(DISTINCT d.user_id) AS dau_count,
               count(DISTINCT CASE WHEN first_seen >= {BE} THEN d.user_id END) AS new_user_count,
               count(DISTINCT CASE WHEN last_seen < {BE} - 1 THEN d.user_id END) AS return_user_count,
               {div('sum(dur)', 'count(*)')} AS avg_duration, {div('sum(pv)', 'count(*)')} AS avg_page_view
        FROM d JOIN s ON d.user_id = s.user_id GROUP BY dev""",
    ),
    "ads_campaign_effect": sql(
        "e p",
        f"""
        , s AS (SELECT tm_id, CASE WHEN value < 10 THEN 'search' ELSE 'social' END AS channel,
                       count(*) FILTER (WHERE event_type = 'view') AS v,
                       count(*) FILTER (WHERE event_type = 'click') AS c,
                       count(*) FILTER (WHERE event_type = 'purchase') AS o,
                       coalesce(sum(CAST(value AS DECIMAL(16,2))) FILTER (WHERE event_type = 'purchase'), 0) AS amt
                FROM e JOIN p ON e.sku_id = p.sku_id GROUP BY ALL)
        SELECT tm_id AS campaign_id, tm_id AS campaign_name, '2024-01-01' AS start_date, '{EVENT_DAY}' AS end_date,
               channel, v AS exposure_count, c AS click_count, {pct('c', 'v')} AS click_rate, o AS order_count,
               {dbl('amt')} AS order_amount, {pct('o', 'c')} AS conversion_rate, {dbl('v')} AS cost,
               CASE WHEN v > 0 THEN {div('amt', 'v')} ELSE 0.0::DOUBLE END AS roi FROM s""",
    ),
    "ads_traffic_source": sql(
        "e",
        f"""
        , s AS (SELECT user_id, date_id,
                       CASE WHEN hour(ts) < 8 THEN 'direct' WHEN hour(ts) < 16 THEN 'search' ELSE 'ads' END AS src,
                       count(*) AS pv, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS dur,
                       count(*) FILTER (WHERE event_type = 'purchase') AS conv FROM e GROUP BY ALL)
        SELECT src AS source_type, src AS source_name, 'web' AS channel, {big('sum(pv)')} AS pv,
               count(DISTINCT user_id) AS uv, {pct('count(*) FILTER (WHERE pv = 1)', 'count(*)')} AS bounce_rate,
               {div('sum(dur)', 'count(*)')} AS avg_session_duration, {big('sum(conv)')} AS conversion_count,
               {pct('sum(conv)', 'count(DISTINCT user_id)')} AS conversion_rate FROM s GROUP BY src""",
    ),
    "ads_coupon_usage": sql(
        "l r",
        COUPONS
        + f""" SELECT {big('k')} AS recent_days, coupon_id, {COUPON_SUMS},
              {pct('count(used_time)', 'count(*)')} AS used_rate
              FROM cu JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY k, coupon_id""",
    ),
    "ads_activity_stats": sql(
        "l r",
        ACTIVITIES
        + f""" SELECT {big('k')} AS recent_days, activity_id, count(DISTINCT user_id) AS participant_count,
              count(DISTINCT order_id) AS participant_order_count, {money('reduced')} AS reduce_amount,
              {div('sum(reduced)', 'count(DISTINCT order_id)')} AS avg_reduce_per_order,
              'discount ' || activity_id AS activity_name, 'reduction' AS activity_type
              FROM ac JOIN r ON day > {BO} - k AND day <= {BO} GROUP BY k, activity_id""",
    ),
    "ads_customer_service": sql(
        "e r",
        TICKETS
        + f""" SELECT {big('k')} AS recent_days, service_type, count(*) AS total_count,
              count(*) FILTER (WHERE state = 'pending') AS pending_count,
              count(*) FILTER (WHERE state = 'processing') AS processing_count,
              count(*) FILTER (WHERE state = 'resolved') AS resolved_count,
              count(*) FILTER (WHERE state = 'unsolved') AS unsolved_count,
              {pct("count(*) FILTER (WHERE state = 'resolved')", 'count(*)')} AS resolved_rate,
              {div("sum(mins * 60) FILTER (WHERE state IN ('resolved', 'unsolved'))",
                   "count(*) FILTER (WHERE state IN ('resolved', 'unsolved')) * 60")} AS avg_handle_time_minutes
              FROM tk JOIN r ON day > {BE} - k AND day <= {BE} GROUP BY k, service_type""",
    ),
    # Batch job
    "payment_way_stats": sql(
        "o",
        f"""SELECT o_orderpriority AS payment_way, count(*) AS order_cnt, {money('amt')} AS gmv
            FROM o GROUP BY 1""",
    ),
    "gmv_overview": sql(
        "o",
        f"""SELECT count(*) AS order_cnt, count(*) FILTER (WHERE status = 'PAID') AS paid_cnt, {money('amt')} AS gmv,
            {div('sum(amt)', 'count(*)')} AS avg_amount FROM o""",
    ),
    "hot_sku_top10": f"""SELECT l_partkey AS sku_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_qty,
        {money('CAST(l_extendedprice AS DECIMAL(16,2))')} AS total_gmv
        FROM lineitem GROUP BY 1 ORDER BY total_qty DESC, sku_id LIMIT 10""",
    "user_level_dist": "SELECT c_mktsegment AS user_level, count(*) AS user_count FROM customer GROUP BY 1",
    "daily_order_trend": sql(
        "o", f"SELECT date_id AS day, count(*) AS order_cnt, {money('amt')} AS gmv FROM o GROUP BY 1"
    ),
    "order_amount_summary": """SELECT count(*) AS cnt, min(o_totalprice) AS min_amount,
        round(quantile_cont(o_totalprice, 0.25), 2) AS p25, round(quantile_cont(o_totalprice, 0.5), 2) AS p50,
        round(quantile_cont(o_totalprice, 0.75), 2) AS p75, max(o_totalprice) AS max_amount FROM orders""",
    "order_amount_windows": sql(
        "o r",
        f"""
        , w AS (SELECT k, amt, row_number() OVER (PARTITION BY k ORDER BY amt) - 1 AS i, count(*) OVER (PARTITION BY k) - 1 AS n
                FROM o JOIN r ON day > {BO} - k AND day <= {BO}),
        j(name, j) AS (VALUES ('p25', 1), ('p50', 2), ('p75', 3)),
        p AS (SELECT k, name, round(sum(amt * CAST(CASE i WHEN n * j // 4 THEN 4 - n * j % 4 ELSE n * j % 4 END AS DECIMAL(2,0))
                                    * CAST(0.25 AS DECIMAL(3,2))), 2) AS v
              FROM w, j WHERE i = n * j // 4 OR (i = n * j // 4 + 1 AND n * j % 4 > 0) GROUP BY k, name)
        SELECT {big('w.k')} AS recent_days, count(*) AS cnt, CAST(min(amt) AS DOUBLE) AS min_amount,
               (SELECT CAST(v AS DOUBLE) FROM p WHERE p.k = w.k AND name = 'p25') AS p25,
               (SELECT CAST(v AS DOUBLE) FROM p WHERE p.k = w.k AND name = 'p50') AS p50,
               (SELECT CAST(v AS DOUBLE) FROM p WHERE p.k = w.k AND name = 'p75') AS p75, CAST(max(amt) AS DOUBLE) AS max_amount
        FROM w GROUP BY w.k""",
    ),
    # Behaviour log
    "log_clean_adaptive": sql("c", "SELECT * FROM c"),
    "log_clean_strict": sql(
        "raw",
        f"""SELECT line_id, {LINE} AS line, t AS event_time, u AS "user", ip, act AS action, prod AS product,
            CASE kind WHEN 0 THEN 'date_format' WHEN 1 THEN 'empty_product' WHEN 2 THEN 'field_count'
                 WHEN 3 THEN 'date_format' END AS reason FROM raw""",
    ),
    "log_clean_repair": sql(
        "raw",
        f"""SELECT line_id, {LINE} AS line, good_t AS event_time, u AS "user", ip, act AS action, prod AS product,
            CASE kind WHEN 1 THEN 'empty_product' WHEN 2 THEN 'field_count' END AS reason FROM raw""",
    ),
    "log_clean_fill": sql(
        "raw",
        f"""SELECT line_id, {LINE} AS line, good_t AS event_time, u AS "user", ip, act AS action,
            CASE WHEN prod = '' THEN 'unknown_product' ELSE coalesce(prod, 'unknown') END AS product FROM raw""",
    ),
    "log_quarantine": sql(
        "raw",
        f"""SELECT line_id, {LINE} AS line,
            CASE kind WHEN 1 THEN 'empty_product' WHEN 2 THEN 'field_count' ELSE 'date_format' END AS reason
            FROM raw WHERE kind <= 3""",
    ),
    "log_clean_outcomes": sql(
        "raw",
        """SELECT CASE kind WHEN 1 THEN 'empty_product' WHEN 2 THEN 'field_count' WHEN 0 THEN 'date_format'
                  WHEN 3 THEN 'date_format' ELSE 'ok' END AS outcome, count(*) AS line_count FROM raw GROUP BY 1""",
    ),
    "clean_adaptive": sql(
        "raw",
        f"""
        , n AS (SELECT count(*) AS total, count(*) FILTER (WHERE kind > 3) AS s0,
                       count(*) FILTER (WHERE kind NOT IN (1, 2)) AS s1 FROM raw),
        s AS (SELECT CAST(0 AS BIGINT) AS strategy, s0 AS kept_lines, total FROM n UNION ALL
              SELECT 1, s1, total FROM n UNION ALL SELECT 2, total, total FROM n),
        x AS (SELECT strategy, kept_lines, total, {pct('kept_lines', 'total')} AS retention_rate FROM s)
        SELECT strategy, kept_lines, total AS total_lines, retention_rate,
               strategy = (SELECT min(strategy) FROM x WHERE retention_rate >= 95 OR strategy = 2) AS chosen FROM x""",
    ),
    "log_basic_stats": sql(
        "c",
        """SELECT count(DISTINCT "user") AS total_users, count(DISTINCT product) AS total_products,
                  count(*) AS total_actions FROM c""",
    ),
    "action_type_stats": _top("action", None),
    "top_products": _top("product", 5),
    "hourly_activity": sql(
        "c",
        f"""
        , h AS (SELECT CAST(range AS BIGINT) AS "hour" FROM range(24)),
        n AS (SELECT h."hour", count(c.line_id) AS event_count
              FROM h LEFT JOIN c ON CAST(substr(event_time, 12, 2) AS BIGINT) = h."hour" GROUP BY 1)
        SELECT "hour", event_count,
               "hour" = (SELECT "hour" FROM n ORDER BY event_count DESC, "hour" DESC LIMIT 1) AS is_peak FROM n""",
    ),
    "category_conversion": sql(
        "c",
        f"""
        , s AS (SELECT p_type AS category, count(*) FILTER (WHERE action = 'view') AS views,
                       count(*) FILTER (WHERE action = 'click') AS carts,
                       count(*) FILTER (WHERE action = 'purchase') AS purchases
                FROM c JOIN part ON product = 'product' || p_partkey GROUP BY p_type)
        SELECT *, {pct('purchases', 'views')} AS view_to_purchase_rate FROM s WHERE views > 0""",
    ),
    "user_paths": sql(
        "c",
        """
        , n AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY event_time, line_id) AS i FROM c)
        SELECT "user", (i - 1) // 1000 AS part, count(*) AS action_count,
               string_agg(action, ' -> ' ORDER BY i) AS path FROM n GROUP BY 1, 2""",
    ),
    "common_trigrams": sql(
        "c",
        """
        , n AS (SELECT action, lead(action, 1) OVER w AS n1, lead(action, 2) OVER w AS n2 FROM c
                WINDOW w AS (PARTITION BY "user" ORDER BY event_time, line_id))
        SELECT action || ' -> ' || n1 || ' -> ' || n2 AS path, count(*) AS path_count
        FROM n WHERE n2 IS NOT NULL GROUP BY 1 ORDER BY path_count DESC, path DESC LIMIT 5""",
    ),
    "burst_users": sql(
        "c",
        """SELECT "user", substr(event_time, 1, 13) AS "hour", count(*) AS event_count
           FROM c GROUP BY 1, 2 HAVING count(*) >= 3""",
    ),
    "suspicious_ips": _top("ip", 5),
    "data_range": sql(
        "c",
        """SELECT min(substr(event_time, 1, 10)) AS first_day, max(substr(event_time, 1, 10)) AS last_day FROM c""",
    ),
    # Ingest filter and checks
    "ingest_incremental": sql(
        "o",
        f"""SELECT id, user_id, {dbl('amt')} AS total_amount,
            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time FROM o WHERE day = {BO}""",
    ),
    "expired_partitions": sql(
        "a", f"SELECT DISTINCT 'dwd_action' AS table_name, date_id AS dt FROM a WHERE day < {BE} - 7"
    ),
    "layer_row_counts_by_dt": sql(
        "o a",
        """SELECT 'dwd_order_info' AS table_name, date_id AS dt, count(*) AS row_count FROM o GROUP BY 2
           UNION ALL SELECT 'dwd_action', date_id, count(*) FROM a GROUP BY 2""",
    ),
}

_LAYERS = """
    SELECT 'ods_user_info' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'ods_sku_info', count(*) FROM part
    UNION ALL SELECT 'ods_order_info', count(*) FROM orders
    UNION ALL SELECT 'ods_order_detail', count(*) FROM lineitem
    UNION ALL SELECT 'dwd_order_info', count(*) FROM orders
    UNION ALL SELECT 'dwd_action', count(*) FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'dwd_order_refund', count(*) FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 'dws_user_day', count(*) FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) FROM orders)
"""
ORACLE["layer_row_counts"] = _LAYERS
ORACLE["quality_gate"] = f"""
    WITH n AS ({_LAYERS}), g AS (SELECT *, CASE table_name WHEN 'ods_user_info' THEN 1000000000000
      WHEN 'dwd_action' THEN 1000 ELSE 1 END AS min_rows FROM n)
    SELECT table_name, row_count, {big('min_rows')} AS min_rows, row_count >= min_rows AS passed FROM g"""
# From stored masks the same results as from the days themselves.
for _name in ("dws_user_retention_day", "ads_user_retention", "ads_user_retention_detail", "ads_user_activity"):
    ORACLE[f"{_name}_masks"] = ORACLE[_name]
ORACLE["ads_gmv_day_bitmaps"] = ORACLE["ads_gmv_day"]
ORACLE["ads_user_repurchase_rate_daily"] = ORACLE["ads_user_repurchase_rate"]
ORACLE["dws_user_action_days"] = sql(
    "a",
    f"""
    , d AS (SELECT DISTINCT user_id, day FROM a WHERE day <= {BE}),
    f AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS cohort FROM d)
    SELECT user_id, strftime(cohort, '%Y-%m-%d') AS create_date,
           {big("sum(CASE WHEN day - cohort < 63 THEN CAST(1 AS BIGINT) << CAST(day - cohort AS BIGINT) ELSE 0 END)")} AS since_first,
           {big(f"sum(CASE WHEN {BE} - day < 63 THEN CAST(1 AS BIGINT) << CAST({BE} - day AS BIGINT) ELSE 0 END)")} AS recent
    FROM f GROUP BY user_id, cohort""",
)
