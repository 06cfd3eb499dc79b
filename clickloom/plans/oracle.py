"""SQL fragments for checking queries on the given tables with another engine."""

from __future__ import annotations

from clickloom.constants import CATEGORICAL_FEATURES, FEATURES, GROUPED_FEATURES, ID_COLUMNS, INTERACTIONS


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


IMP = """
imp AS (
  SELECT event_id, epoch_us(ts) AS us, user_id AS userid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS adgroup_id,
         CAST(event_type = 'click' AS BIGINT) AS click,
         'slot_' || CAST(event_id % 2 AS VARCHAR) AS pid,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
         CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
         CASE WHEN ts < TIMESTAMP '2024-01-25 00:00:00' THEN 'train' ELSE 'test' END AS _split
  FROM events)"""

ADS = """
raw_ads AS (
  SELECT p_partkey AS adgroup_id, p_type AS cate_id, CAST(p_size AS BIGINT) AS campaign_id,
         p_partkey % 37 AS customer,
         CASE WHEN p_partkey % 10 <> 0 THEN CAST(substr(p_brand, 7) AS DOUBLE) END AS brand,
         p_retailprice AS price
  FROM part),
ads AS (
  SELECT adgroup_id, cate_id, campaign_id, customer,
         COALESCE(NULLIF(CAST(CAST(brand AS BIGINT) AS VARCHAR), '-1'), 'unknown') AS brand, price
  FROM raw_ads)"""

USERS = """
raw_users AS (
  SELECT c_custkey AS userid, CAST(c_nationkey AS BIGINT) AS cms_segid, c_mktsegment AS cms_group_id,
         c_custkey % 2 + 1 AS final_gender_code, CAST(n_regionkey AS BIGINT) AS age_level,
         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 4000) AS BIGINT) + 1 END AS pvalue_level,
         c_custkey % 3 + 1 AS shopping_level, CAST(c_custkey % 7 = 0 AS BIGINT) AS occupation,
         NULLIF(c_custkey % 5, 0) AS new_user_class_level
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
users AS (
  SELECT userid, cms_segid, cms_group_id, final_gender_code, age_level,
         COALESCE(CAST(pvalue_level AS VARCHAR), 'unknown') AS pvalue_level, shopping_level, occupation,
         COALESCE(CAST(new_user_class_level AS VARCHAR), 'unknown') AS new_user_class_level
  FROM raw_users)"""

STAR = f"""{IMP},{ADS},{USERS},
star AS (
  SELECT imp.*, cate_id, campaign_id, customer, brand, price, cms_segid, cms_group_id, final_gender_code,
         age_level, pvalue_level, shopping_level, occupation, new_user_class_level
  FROM imp LEFT JOIN ads USING (adgroup_id) LEFT JOIN users USING (userid)),
gm AS (SELECT avg(click) AS gm FROM star WHERE _split = 'train'),
mp AS (SELECT avg(price) AS mp FROM star WHERE _split = 'train')"""

DIRTY = f"""{IMP},
dirty AS (SELECT *, 0 AS copy_no FROM imp UNION ALL SELECT *, 1 AS copy_no FROM imp WHERE event_id % 10 = 0)"""

FOLD = "CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 5"


def prefix(keys: str) -> str:
    return f"(PARTITION BY {keys} ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def trailing(key: str, width_us: int) -> str:
    return f"(PARTITION BY {key} ORDER BY us RANGE BETWEEN {width_us - 1} PRECEDING AND 1 PRECEDING)"


def before(keys: str, name: str) -> str:
    return (
        f"COALESCE(sum(click) OVER {prefix(keys)}, 0) AS {name}_clicks_before, "
        f"count(*) OVER {prefix(keys)} AS {name}_impressions_before"
    )


def _encodings() -> str:
    parts = ["folded AS (SELECT *, " + FOLD + " AS fold FROM star)"]
    for c in ID_COLUMNS:
        parts.append(f"tot_{c} AS (SELECT {c}, sum(click) AS s, count(*) AS n FROM folded WHERE _split = 'train' GROUP BY {c})")
        parts.append(f"fld_{c} AS (SELECT {c}, fold, sum(click) AS s, count(*) AS n FROM folded WHERE _split = 'train' GROUP BY {c}, fold)")
    cols = ", ".join(
        f"""COALESCE(CASE WHEN _split = 'train' THEN (t_{c}.s - f_{c}.s + gm * 20.0::DOUBLE) / (t_{c}.n - f_{c}.n + 20.0::DOUBLE)
            ELSE (t_{c}.s + gm * 20.0::DOUBLE) / (t_{c}.n + 20.0::DOUBLE) END, gm) AS {c}_te""" for c in ID_COLUMNS
    )
    joins = " ".join(
        f"LEFT JOIN tot_{c} t_{c} ON r.{c} = t_{c}.{c} LEFT JOIN fld_{c} f_{c} ON r.{c} = f_{c}.{c} AND r.fold = f_{c}.fold"
        for c in ID_COLUMNS
    )
    parts.append(f"encoded AS (SELECT r.*, {cols} FROM folded r CROSS JOIN gm {joins})")
    return ",\n".join(parts)


ENCODED = f"{STAR},\n{_encodings()}"

DAY = 86_400_000_000


def _freq(a: str, b: str) -> str:
    return (
        f"COALESCE((CASE WHEN true THEN count(*) FILTER (WHERE _split = 'train') OVER (PARTITION BY {a}, {b}) END)"
        f" / CAST(count(*) FILTER (WHERE _split = 'train') OVER () AS DOUBLE), 0) AS {a}_x_{b}_freq"
    )


HISTORY = f"""{ENCODED},
hist AS (
  SELECT *,
    {before("adgroup_id", "ag")}, {before("cate_id", "cate")}, {before("userid", "user")}, {before("brand", "brand")},
    {before("userid, cate_id", "user_cate")}, {before("userid, brand", "user_brand")},
    round(COALESCE(sum(price * click) OVER {prefix("adgroup_id")}, 0), 6) AS ag_revenue_before,
    count(*) OVER {trailing("adgroup_id", DAY)} AS ag_impressions_last_1d,
    COALESCE(sum(click) OVER {trailing("adgroup_id", DAY)}, 0) AS ag_clicks_last_1d,
    count(*) OVER {trailing("adgroup_id", 3 * DAY)} AS ag_impressions_last_3d,
    COALESCE(sum(click) OVER {trailing("adgroup_id", 3 * DAY)}, 0) AS ag_clicks_last_3d,
    last_value(CASE WHEN click = 1 THEN adgroup_id END IGNORE NULLS) OVER {prefix("userid")} AS user_prev_clicked_item,
    sum(CASE WHEN click = 1 THEN price END) OVER {prefix("userid")} AS paid,
    count(CASE WHEN click = 1 THEN price END) OVER {prefix("userid")} AS paid_n,
    {", ".join(_freq(a, b) for a, b in INTERACTIONS)}
  FROM encoded),
pairs AS (
  SELECT event_id,
    COALESCE(sum(click) OVER {prefix("user_prev_clicked_item, adgroup_id")}, 0) AS pair_clicks,
    COALESCE(sum(click) OVER {prefix("user_prev_clicked_item")}, 0) AS prev_clicks
  FROM hist WHERE user_prev_clicked_item IS NOT NULL),
feat AS (
  SELECT hist.*,
    COALESCE(ag_clicks_before / NULLIF(CAST(ag_impressions_before AS DOUBLE), 0), gm) AS ag_ctr_before,
    COALESCE(cate_clicks_before / NULLIF(CAST(cate_impressions_before AS DOUBLE), 0), gm) AS cate_ctr_before,
    COALESCE(user_clicks_before / NULLIF(CAST(user_impressions_before AS DOUBLE), 0), gm) AS user_ctr_before,
    COALESCE(brand_clicks_before / NULLIF(CAST(brand_impressions_before AS DOUBLE), 0), gm) AS brand_ctr_before,
    COALESCE(ag_clicks_last_1d / NULLIF(CAST(ag_impressions_last_1d AS DOUBLE), 0), gm) AS ag_ctr_last_1d,
    COALESCE(ag_clicks_last_3d / NULLIF(CAST(ag_impressions_last_3d AS DOUBLE), 0), gm) AS ag_ctr_last_3d,
    COALESCE(ag_clicks_last_1d / NULLIF(CAST(ag_impressions_last_1d AS DOUBLE), 0), gm)
      - COALESCE(ag_clicks_last_3d / NULLIF(CAST(ag_impressions_last_3d AS DOUBLE), 0), gm) AS ag_ctr_trend_1d_vs_3d,
    (user_cate_clicks_before + gm * 20.0::DOUBLE) / (user_cate_impressions_before + 20.0::DOUBLE) AS user_cate_affinity_before,
    (user_brand_clicks_before + gm * 20.0::DOUBLE) / (user_brand_impressions_before + 20.0::DOUBLE) AS user_brand_affinity_before,
    round(COALESCE(paid / NULLIF(CAST(paid_n AS DOUBLE), 0), mp), 6) AS user_avg_clicked_price_before,
    price - round(COALESCE(paid / NULLIF(CAST(paid_n AS DOUBLE), 0), mp), 6) AS user_price_gap,
    COALESCE(pair_clicks / NULLIF(CAST(prev_clicks AS DOUBLE), 0), 0) AS item_coclick_affinity
  FROM hist LEFT JOIN pairs USING (event_id) CROSS JOIN gm CROSS JOIN mp)"""

GOLD = f"""{HISTORY},
gold AS (
  SELECT event_id, us, userid AS userid_key, adgroup_id AS adgroup_id_key, user_prev_clicked_item, _split, click,
    {", ".join(f"COALESCE(CAST({c} AS VARCHAR), '-1') AS {c}" for c in CATEGORICAL_FEATURES)},
    {", ".join(c for c in FEATURES if c not in CATEGORICAL_FEATURES)}
  FROM feat)"""

CATALOG = f"""{GOLD},
train AS (SELECT * FROM gold WHERE _split = 'train'),
gmt AS (SELECT avg(click) AS gm, avg(price) AS mp, count(*) AS n FROM train),
products AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY adgroup_id_key ORDER BY us DESC, event_id DESC) AS rn FROM train)
  WHERE rn = 1),
cates AS (
  SELECT cate_id, cate_clicks_before, cate_impressions_before, cate_ctr_before FROM (
    SELECT *, row_number() OVER (PARTITION BY cate_id ORDER BY us DESC, event_id DESC) AS rn FROM train)
  WHERE rn = 1),
catalog AS (
  SELECT p.adgroup_id_key AS adgroup_id, p.cate_id, p.brand, p.price, p.adgroup_id_te, p.campaign_id_te, p.customer_te,
    p.ag_clicks_before, p.ag_impressions_before, p.ag_ctr_before, p.ag_revenue_before, p.ag_impressions_last_1d,
    p.ag_ctr_last_1d, p.ag_impressions_last_3d, p.ag_ctr_last_3d, p.ag_ctr_trend_1d_vs_3d,
    c.cate_clicks_before, c.cate_impressions_before, c.cate_ctr_before
  FROM products p LEFT JOIN cates c USING (cate_id)),
uc AS (SELECT userid_key, cate_id, (sum(click) + max(gm) * 20.0::DOUBLE) / (count(*) + 20.0::DOUBLE) AS v
       FROM train CROSS JOIN gmt GROUP BY 1, 2),
ub AS (SELECT userid_key, brand, (sum(click) + max(gm) * 20.0::DOUBLE) / (count(*) + 20.0::DOUBLE) AS v
       FROM train CROSS JOIN gmt GROUP BY 1, 2),
up AS (SELECT userid_key, avg(price) AS v FROM train WHERE click = 1 GROUP BY 1),
snap AS (
  SELECT prev_item, item, cnt, sum(cnt) OVER (PARTITION BY prev_item) AS total FROM (
    SELECT user_prev_clicked_item AS prev_item, adgroup_id_key AS item, count(*) AS cnt
    FROM train WHERE click = 1 AND user_prev_clicked_item IS NOT NULL GROUP BY 1, 2)),
f_pc AS (SELECT pid, cate_id, count(*) / CAST(max(n) AS DOUBLE) AS v FROM train CROSS JOIN gmt GROUP BY 1, 2),
f_ca AS (SELECT cate_id, age_level, count(*) / CAST(max(n) AS DOUBLE) AS v FROM train CROSS JOIN gmt GROUP BY 1, 2),
f_bc AS (SELECT brand, cms_group_id, count(*) / CAST(max(n) AS DOUBLE) AS v FROM train CROSS JOIN gmt GROUP BY 1, 2)"""


def candidates(queries: str) -> str:
    """Candidate table ``cand`` of a query CTE with the user context columns."""
    return f"""
cand AS (
  SELECT q.*, c.adgroup_id, c.cate_id AS c_cate, c.price AS c_price, c.ag_ctr_before,
    COALESCE(f_pc.v, 0) AS f_pid_cate, COALESCE(f_ca.v, 0) AS f_cate_age, COALESCE(f_bc.v, 0) AS f_brand_cms,
    COALESCE(uc.v, gmt.gm) AS user_cate, COALESCE(ub.v, gmt.gm) AS user_brand,
    c.price - COALESCE(up.v, gmt.mp) AS price_gap,
    COALESCE(snap.cnt / CAST(snap.total AS DOUBLE), 0) AS coclick
  FROM {queries} q CROSS JOIN catalog c CROSS JOIN gmt
  LEFT JOIN f_pc ON f_pc.pid = q.pid AND f_pc.cate_id = c.cate_id
  LEFT JOIN f_ca ON f_ca.cate_id = c.cate_id AND f_ca.age_level = q.age_level
  LEFT JOIN f_bc ON f_bc.brand = c.brand AND f_bc.cms_group_id = q.cms_group_id
  LEFT JOIN uc ON uc.userid_key = q.userid AND uc.cate_id = c.cate_id
  LEFT JOIN ub ON ub.userid_key = q.userid AND ub.brand = c.brand
  LEFT JOIN up ON up.userid_key = q.userid
  LEFT JOIN snap ON snap.prev_item = q.user_prev_clicked_item AND snap.item = c.adgroup_id),
scored AS (
  SELECT *, ag_ctr_before + user_cate * 0.5::DOUBLE + user_brand * 0.5::DOUBLE + coclick * 0.25::DOUBLE + f_pid_cate
            - price_gap * 0.0001::DOUBLE AS score
  FROM cand)"""


QUERIES = f"""{CATALOG},
queries AS (
  SELECT event_id AS query_id, adgroup_id_key AS true_adgroup_id, userid_key AS userid, pid, age_level, cms_group_id,
         user_prev_clicked_item
  FROM gold WHERE _split = 'test' AND click = 1),{candidates("queries")}"""


def ranks(score: str) -> str:
    """CTE ``ranks`` with the 0-based rank of the clicked ad under a score column of ``scored``."""
    return f"""
ranked AS (
  SELECT query_id, adgroup_id, row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC, adgroup_id) - 1 AS rank FROM scored),
ranks AS (
  SELECT q.query_id, q.true_adgroup_id, COALESCE(r.rank, n.n) AS rank, n.n AS catalog_size
  FROM queries q CROSS JOIN (SELECT count(*) AS n FROM catalog) n
  LEFT JOIN ranked r ON r.query_id = q.query_id AND r.adgroup_id = q.true_adgroup_id)"""


def values_of(features: list[str], table: str = "gold") -> str:
    """CTE ``vals``: distinct values per feature with counts and everything below."""
    union = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, click FROM {table}" for f in features)
    over = "OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
longf AS ({union}),
grp AS (SELECT feature, value, count(*) AS n, sum(click) AS pos FROM longf WHERE value IS NOT NULL GROUP BY 1, 2),
vals AS (
  SELECT *, COALESCE(sum(n) {over}, 0) AS n_below, COALESCE(sum(pos) {over}, 0) AS pos_below,
         sum(n) OVER (PARTITION BY feature) AS n_total, sum(pos) OVER (PARTITION BY feature) AS pos_total
  FROM grp)"""


GOLD_VALUES = f"{GOLD},{values_of(GROUPED_FEATURES)}"
