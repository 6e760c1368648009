"""The adapters of ``sources.tables`` written in DuckDB SQL, as CTEs."""

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

VIEWS = {
    "uva": f"""
SELECT CAST(ts AS DATE) AS date, user_id,
  concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
  {_K} % 10 AS page_id, ts AS action_time, event_id,
  CASE WHEN event_type='view' THEN concat('kw', CAST({_K} % 10 AS VARCHAR)) END AS search_keyword,
  CASE WHEN event_type='click' THEN {_K} % 20 END AS click_category_id,
  CASE WHEN event_type='click' THEN event_id % 100 END AS click_product_id,
  CASE WHEN event_type='signup' THEN
    concat(CAST({_K} % 20 AS VARCHAR), ',', CAST(({_K}+7) % 20 AS VARCHAR)) END AS order_category_ids,
  CASE WHEN event_type='purchase' THEN CAST({_K} % 20 AS VARCHAR) END AS pay_category_ids,
  user_id % 25 AS city_id
FROM events""",
    "ui": """
SELECT c_custkey AS user_id, c_name AS name, CAST(18 + c_custkey % 50 AS INT) AS age,
  c_mktsegment AS professional, concat('city', CAST(c_nationkey AS VARCHAR)) AS city,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
FROM customer""",
    "pi": """
SELECT p_partkey AS product_id, p_name AS product_name,
  concat('{"product_status":', CAST(p_partkey % 2 AS VARCHAR), '}') AS extend_info FROM part""",
    "ci": """
SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "ads": f"""
SELECT event_id, epoch_us(ts)//1000 AS click_ms, strftime(ts, '%Y-%m-%d') AS date,
  concat('P', CAST(user_id % 5 AS VARCHAR)) AS province,
  concat('C', CAST(user_id % 25 AS VARCHAR)) AS city, user_id, {_K} % 10 AS ad_id
FROM events""",
    "el": f"""
SELECT event_id, epoch_us(ts)//1000 AS s_time, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt,
  CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'error' THEN 'e_e' ELSE 'e_pv' END AS en,
  CASE WHEN event_id % 50 = 0 THEN '' WHEN user_id % 3 = 0 THEN 'java_server' ELSE 'website' END AS pl,
  concat('u', CAST(user_id AS VARCHAR)) AS u_ud,
  CASE WHEN user_id % 2 = 0 THEN concat('m', CAST(user_id AS VARCHAR)) END AS u_mid,
  concat(CAST(user_id AS VARCHAR),'-',CAST(CAST(ts AS DATE) AS VARCHAR)) AS u_sd,
  CASE {_K} % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'IE' WHEN 2 THEN 'Firefox' ELSE '' END AS browser,
  concat('v', CAST({_K} % 3 AS VARCHAR)) AS browser_v,
  concat('http://shop.example.com/p/', CAST({_K} % 10 AS VARCHAR)) AS p_url,
  CASE {_K} % 5 WHEN 0 THEN 'https://www.search-a.example/q?x=1' WHEN 1 THEN 'http://m.search-b.example/'
    WHEN 2 THEN 'http://blog.other.example/' WHEN 3 THEN 'http://shop.example.com/p/1' END AS p_ref,
  CASE WHEN user_id % 5 = 0 THEN 'unknown' ELSE 'CN' END AS country,
  concat('prov', CAST(user_id % 5 AS VARCHAR)) AS province,
  concat('city', CAST(user_id % 25 AS VARCHAR)) AS city,
  concat(CAST(10 + {_K} % 5 AS VARCHAR),'.',CAST(user_id % 256 AS VARCHAR),'.',
    CAST({_K} AS VARCHAR),'.',CAST(event_id % 256 AS VARCHAR)) AS ip,
  CASE WHEN event_type='error' THEN concat('cat', CAST({_K} % 3 AS VARCHAR)) END AS ca,
  CASE WHEN event_type='error' THEN concat('act', CAST({_K} % 4 AS VARCHAR)) END AS ac,
  {_K} AS k
FROM events""",
    "oe": """
SELECT CAST(o_orderkey AS VARCHAR) AS oid, e.en, epoch_us(o_orderdate)//1000 + e.after AS s_time,
  strftime(o_orderdate + e.after * INTERVAL 1 MILLISECOND, '%Y-%m-%d') AS date,
  CASE WHEN o_custkey % 3 = 0 THEN 'java_server' ELSE 'website' END AS pl,
  CASE WHEN o_orderkey % 4 = 0 THEN 'USD' ELSE 'RMB' END AS cut,
  CASE WHEN e.again THEN 'card' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'alipay' WHEN 1 THEN 'weixin' ELSE 'card' END END AS pt,
  CAST(floor(o_totalprice) AS BIGINT) + CAST(e.again AS BIGINT) AS cua
FROM orders CROSS JOIN (VALUES ('e_crt', 0, false), ('e_crt', 60000, true), ('e_cs', 3600000, false),
  ('e_cr', 7200000, false)) e(en, after, again)
WHERE (e.en='e_crt' AND (NOT e.again OR o_orderkey % 7 = 0)) OR (e.en='e_cs' AND o_orderstatus IN ('F','P'))
  OR (e.en='e_cr' AND o_orderstatus='P')""",
    "emp": """
SELECT c_name AS name, 18 + c_custkey % 50 AS age, CAST(c_nationkey AS BIGINT) AS depId,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender, c_acctbal AS salary FROM customer""",
    "dept": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
    "gr": "SELECT p_partkey AS id, p_brand AS class, CAST(p_size AS BIGINT) AS grade FROM part",
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views; ``body`` may start with ', x AS (…)'."""
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    return f"WITH {ctes} {body.strip()}"


def ratio2(n: str, d: str) -> str:
    """n/d rounded half up to two decimals by integer arithmetic."""
    return f"(((2*({n})*100 + ({d})) // (2*({d}))) / 100.0)"
