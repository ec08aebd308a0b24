"""One query for each family of scalar functions, over values derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.plans.registry import query
from factloom.sources.tables import load

# The twin states its own tables: it must not agree with the functions by sharing theirs.
FOLD = "translate(lower(raw), 'áàâäãåāéèêëēęíìîïīóòôöõōøúùûüūñńçćšśžźżýÿłæœß', 'aaaaaaaeeeeeeiiiiiooooooouuuuunnccsszzzyylaos')"
PLAIN = rf"trim(regexp_replace(regexp_replace(regexp_replace({FOLD}, '[-''.,/\s]+', ' ', 'g'), '[^0-9a-z ]', '', 'g'), ' +', ' ', 'g'))"
NORMALIZE = f"reverse(regexp_replace(reverse({PLAIN}), '^((loohcs hgih|sh|loohcshgih|loohcs|hgih rs|hgih roines) )+', ''))"
NAMES = [" High School", "-HS", " Sr. High", " École's", " Łódź Straße", " Ærø Œuvre", " Senior High School", " Ńńćś-Żźšž/Āēīōūę HS School"]


@query(f"""
WITH r AS (SELECT p_partkey, p_name || (['{"', '".join(n.replace("'", "''") for n in NAMES)}'])[p_partkey % 8 + 1] AS raw FROM part)
SELECT p_partkey, {NORMALIZE} AS normalized, lower(regexp_replace(raw, '[^0-9A-Za-z]', '', 'g')) AS compressed FROM r""")
def normalize_names(spark, sf):
    raw = F.concat("p_name", F.element_at(F.array(*map(F.lit, NAMES)), (F.col("p_partkey") % 8 + 1).cast("int")))
    return load(spark, sf, "part").select("p_partkey", S.normalize_name(raw).alias("normalized"), S.compressed(raw).alias("compressed"))


@query("""
WITH v AS (SELECT DISTINCT l_partkey AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
c AS (SELECT k, q, CASE k % 6 WHEN 0 THEN (q + 40) || '.2' WHEN 1 THEN (q * 3) || ':12.3' WHEN 2 THEN '1:' || lpad(CAST(q + 30 AS VARCHAR), 2, '0') || ':05' WHEN 3 THEN '2:' || (q + 30) || '.5' WHEN 4 THEN q || ':' ELSE q || '' END AS clock FROM v)
SELECT clock, any_value(CASE k % 6 WHEN 0 THEN (q + 40) * 1000000000 + 200000000 WHEN 1 THEN q * 3 * 60000000000 + 12300000000 WHEN 2 THEN CASE WHEN q + 30 < 60 THEN (90 + q) * 60000000000 + 5000000000 END WHEN 3 THEN CASE WHEN q + 30 < 60 THEN (150 + q) * 1000000000 + 500000000 END WHEN 5 THEN q * 1000000000 END) AS ns
FROM c GROUP BY 1""")
def clock_forms(spark, sf):
    """Clock texts of every form, with seconds and minutes above 60 where they may be and where not."""
    v = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("long").alias("q")).distinct()
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    q = lambda n=0, m=1: (F.col("q") * m + n).cast("string")
    k = F.col("k") % 6
    clock = F.when(k == 0, text(q(40), ".2")).when(k == 1, text(q(0, 3), ":12.3")).when(k == 2, text("1:", q(30), ":05")).when(k == 3, text("2:", q(30), ".5")).when(k == 4, text(q(), ":")).otherwise(q())
    return v.select(clock.alias("clock")).distinct().select("clock", S.parse_clock_ns("clock").alias("ns"))


@query("SELECT c_custkey, 'cust_' || substr(sha256('cust' || chr(31) || c_name || chr(31) || CAST(c_nationkey AS VARCHAR)), 1, 16) AS id FROM customer")
def mint_ids(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", S.mint_id("cust", "c_name", "c_nationkey").alias("id"))


NS = "CAST(l_quantity * 100 AS BIGINT) * 7 * 10000000 + l_linenumber * 10000000"


@query(f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {NS} AS ns FROM lineitem),
p AS (SELECT *, ns // 1000000000 AS t, ns % 1000000000 // 10000000 AS f FROM v)
SELECT DISTINCT ns, CASE WHEN t >= 60 THEN CAST(t // 60 AS VARCHAR) || ':' || lpad(CAST(t % 60 AS VARCHAR), 2, '0') ELSE CAST(t AS VARCHAR) END || '.' || lpad(CAST(f AS VARCHAR), 2, '0') AS clock, ns AS parsed FROM p""")
def clock_roundtrip(spark, sf):
    """Nanoseconds to a clock text and back."""
    ns = (F.col("l_quantity") * 100).cast("long") * 7 * 10_000_000 + F.col("l_linenumber") * 10_000_000
    v = load(spark, sf, "lineitem").select(ns.cast("long").alias("ns")).distinct().withColumn("clock", S.format_clock("ns"))
    return v.select("ns", "clock", S.parse_clock_ns("clock").alias("parsed"))


@query("""
SELECT DISTINCT CAST(l_quantity AS BIGINT) || '-' || lpad(CAST(l_linenumber % 14 AS VARCHAR), 2, '0') || '.25' AS mark,
  CASE WHEN l_linenumber % 14 < 12 THEN ((CAST(l_quantity AS BIGINT) * 12 + l_linenumber % 14) * 100 + 25) * 254 END AS um FROM lineitem""")
def feet_inches(spark, sf):
    mark = F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("-"), F.lpad((F.col("l_linenumber") % 14).cast("string"), 2, "0"), F.lit(".25"))
    return load(spark, sf, "lineitem").select(mark.alias("mark")).distinct().select("mark", S.parse_feet_um("mark").alias("um"))


@query("""
SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS school_year,
  (year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END) || '-' || lpad(CAST((year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END + 1) % 100 AS VARCHAR), 2, '0') AS label,
  CASE WHEN o_custkey % 6 + 8 BETWEEN 9 AND 12 AND year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END + 33 - (o_custkey % 6 + 8) BETWEEN 2020 AND 2040 THEN year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END + 33 - (o_custkey % 6 + 8) END AS graduation,
  strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter
FROM orders""")
def calendar_fields(spark, sf):
    y = S.school_year("o_orderdate")
    grade = F.col("o_custkey") % 6 + 8
    return load(spark, sf, "orders").select("o_orderkey", y.alias("school_year"), S.year_label(y).alias("label"), S.graduation_year(y + 20, grade).alias("graduation"), F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd").alias("quarter"))


@query("""
WITH l AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1)
SELECT o_custkey, strftime(date_trunc('year', last), '%Y-%m-%d') AS window_start, strftime(date_trunc('year', last) + INTERVAL 1 YEAR, '%Y-%m-%d') AS next_start, date_trunc('year', last) + INTERVAL 1 YEAR <= TIMESTAMP '1998-06-01' AS due
FROM l""")
def cadence_due(spark, sf):
    """The yearly window at or before the last run, the next one, and whether it is due."""
    l = load(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    start = F.date_trunc("year", "last")
    following = F.add_months(start.cast("date"), 12)
    return l.select("o_custkey", F.date_format(start, "yyyy-MM-dd").alias("window_start"), F.date_format(following, "yyyy-MM-dd").alias("next_start"), (following <= F.lit("1998-06-01").cast("date")).alias("due"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_id % 7 = 0 THEN 'unknown' WHEN value <= 2.0 THEN 'legal' ELSE 'assisted' END AS wind,
  CASE event_id % 3 WHEN 0 THEN 'fat' WHEN 1 THEN 'hand' ELSE 'unknown' END AS timing
FROM events""")
def mark_classes(spark, sf):
    """Wind class and timing class of marks such as 11.32h and 24.95a."""
    k = F.col("event_id") % 3
    mark = F.concat(F.lit("11.3"), F.when(k == 0, "2a").when(k == 1, "2h").otherwise("2"))
    wind = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return load(spark, sf, "events").select("event_id", S.wind_class(wind, F.col("event_type") != "error").alias("wind"), S.timing_suffix(mark).alias("timing"))


TOKENS = "['dq', 'DNF', ' ns', '--', 'x', '12.5']"


@query(f"SELECT DISTINCT tok, CASE WHEN upper(trim(tok)) IN {S.TERMINAL} THEN 'terminal' WHEN upper(trim(tok)) IN {S.AMBIGUOUS} THEN 'ambiguous' ELSE 'mark' END AS status FROM (SELECT unnest({TOKENS}) AS tok FROM region)")
def result_status(spark, sf):
    toks = F.array(*map(F.lit, ["dq", "DNF", " ns", "--", "x", "12.5"]))
    return load(spark, sf, "region").select(F.explode(toks).alias("tok")).distinct().select("tok", S.result_status("tok").alias("status"))


@query("""
SELECT DISTINCT raw, CASE WHEN regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN strftime(try_strptime(raw, '%Y-%m-%d'), '%Y-%m-%d') WHEN contains(raw, '/') THEN strftime(try_strptime(raw, '%m/%d/%Y'), '%Y-%m-%d') WHEN contains(raw, ',') THEN strftime(try_strptime(raw, '%b %d, %Y'), '%Y-%m-%d') END AS day FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%b %d, %Y') ELSE strftime(o_orderdate, '%Y-%m') || '-99' END AS raw FROM orders)""")
def published_dates(spark, sf):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy")).when(k == 2, F.date_format(d, "MMM dd, yyyy")).otherwise(F.concat(F.date_format(d, "yyyy-MM"), F.lit("-99")))
    return load(spark, sf, "orders").select(raw.alias("raw")).distinct().select("raw", F.date_format(S.published_date("raw"), "yyyy-MM-dd").alias("day"))


@query(r"""
SELECT c_custkey, CASE WHEN regexp_matches(cell, '^[\s\x00-\x1f]*[=+@-]') THEN '''' || cell ELSE cell END AS cell FROM (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '=' || c_name WHEN 1 THEN ' -' || c_name WHEN 2 THEN c_name ELSE '@' || c_mktsegment END AS cell FROM customer)""")
def csv_protected(spark, sf):
    k = F.col("c_custkey") % 4
    cell = F.when(k == 0, F.concat(F.lit("="), "c_name")).when(k == 1, F.concat(F.lit(" -"), "c_name")).when(k == 2, F.col("c_name")).otherwise(F.concat(F.lit("@"), "c_mktsegment"))
    return load(spark, sf, "customer").select("c_custkey", S.csv_protect(cell).alias("cell"))


@query("""
SELECT s_suppkey, regexp_replace(s_name, '^([^,]+),\\s*(.+)$', '\\2 \\1') AS same, split_part(s_name, '#', 2) || ' ' || split_part(s_name, '#', 1) AS flipped,
  CAST(round(s_acctbal / 100, 2) AS DECIMAL(10,7)) AS coordinate
FROM supplier""".replace("\\\\", "\\"))
def person_and_place(spark, sf):
    """Last-first flip and seven-decimal coordinates."""
    s = load(spark, sf, "supplier")
    last_first = F.concat_ws(", ", F.substring_index("s_name", "#", 1), F.substring_index("s_name", "#", -1))
    return s.select("s_suppkey", S.flip_last_first("s_name").alias("same"), S.flip_last_first(last_first).alias("flipped"), S.coordinate(F.round(F.col("s_acctbal") / 100, 2).cast("string")).alias("coordinate"))


LABELS = {"click": "press", "purchase": "order", "view": "look"}


@query(f"""
SELECT event_id, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())} ELSE 'unmapped:' || event_type END AS kind,
  CASE WHEN event_type = 'error' THEN 'excluded' WHEN event_type IN {tuple(LABELS)} THEN 'included' ELSE 'unresolved' END AS disposition
FROM events""")
def event_admission(spark, sf):
    """Labels mapped by a table, and each event included, excluded or unresolved with its reason kept."""
    lookup = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    kind = F.try_element_at(lookup, F.col("event_type"))
    disposition = F.when(F.col("event_type") == "error", "excluded").when(kind.isNotNull(), "included").otherwise("unresolved")
    return load(spark, sf, "events").select("event_id", F.coalesce(kind, F.concat(F.lit("unmapped:"), "event_type")).alias("kind"), disposition.alias("disposition"))


@query("""
SELECT user_id, CASE WHEN count(DISTINCT event_type) FILTER (WHERE event_type <> 'view') > 1 THEN 'LOW' WHEN count(*) FILTER (WHERE event_type <> 'view') > 0 THEN 'HIGH' END AS confidence FROM events GROUP BY 1""")
def cohort_confidence(spark, sf):
    """Differing claims give LOW; support without conflict HIGH; no support none."""
    claim = F.when(F.col("event_type") != "view", F.col("event_type"))
    e = load(spark, sf, "events").groupBy("user_id").agg(F.min(claim).alias("a"), F.max(claim).alias("b"))
    return e.select("user_id", F.when(F.col("a") != F.col("b"), "LOW").when(F.col("a").isNotNull(), "HIGH").alias("confidence"))


@query("""
WITH a AS (SELECT user_id, list(event_type ORDER BY event_id) AS ev FROM events GROUP BY 1),
k AS (SELECT user_id, len(ev) AS before, list_filter(ev, lambda x: x IN ('purchase', 'click')) AS core FROM a)
SELECT user_id, before, len(core) AS after, core[1] AS primary_evidence FROM k WHERE len(core) > 0""")
def evidence_scope(spark, sf):
    """Only core evidence stays inside a row; emptied rows go; the first core item is the primary one."""
    ev = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"])
    a = load(spark, sf, "events").groupBy("user_id").agg(ev.alias("ev")).withColumn("core", F.filter("ev", lambda x: x.isin("purchase", "click")))
    return a.where("size(core) > 0").select("user_id", F.size("ev").cast("long").alias("before"), F.size("core").cast("long").alias("after"), F.try_element_at("core", F.lit(1)).alias("primary_evidence"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'any_course' WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'same_course:' || o_orderstatus END AS course_key, CASE WHEN o_orderstatus = 'P' THEN 'unknown_basis' ELSE 'none' END AS adjustment FROM orders""")
def course_policy(spark, sf):
    o = load(spark, sf, "orders")
    key = F.when(F.col("o_orderpriority") == "1-URGENT", "any_course").when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), F.concat(F.lit("same_course:"), "o_orderstatus"))
    return o.select("o_orderkey", key.alias("course_key"), F.when(F.col("o_orderstatus") == "P", "unknown_basis").otherwise("none").alias("adjustment"))
