"""Entity resolution, aliases, graphs, and the parsers of pages, events and plain texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import labels, resolve
from factloom.plans.registry import query
from factloom.plans.scalars_catalogue import NORMALIZE
from factloom.sources import parsers
from factloom.sources.tables import load


@query("""
WITH idx AS (SELECT p_type, lower(p_name) AS name, count(DISTINCT p_partkey) AS n, min(p_partkey) AS id FROM part WHERE p_size <= 10 GROUP BY 1, 2),
raw AS (SELECT p_partkey, p_type, lower(p_name) AS exact, lower(regexp_replace(p_name, ' [^ ]+$', '')) AS short FROM part WHERE p_size > 10)
SELECT p_partkey, CASE WHEN a.n > 1 THEN 'ambiguous' WHEN a.n = 1 THEN 'exact' WHEN b.n > 1 THEN 'ambiguous' WHEN b.n = 1 THEN 'stripped' ELSE 'unresolved' END AS outcome,
  CASE WHEN a.n IS NOT NULL THEN CASE WHEN a.n = 1 THEN CAST(a.id AS VARCHAR) END WHEN b.n = 1 THEN CAST(b.id AS VARCHAR) END AS match
FROM raw LEFT JOIN idx a ON raw.p_type = a.p_type AND exact = a.name LEFT JOIN idx b ON raw.p_type = b.p_type AND short = b.name""")
def label_resolve(spark, sf):
    """Steps in order, each unique, ambiguous or absent; the first that is not absent decides."""
    p = load(spark, sf, "part")
    index = p.where("p_size <= 10").select("p_type", F.lower("p_name").alias("name"), F.col("p_partkey").alias("id"))
    labels = p.where("p_size > 10").select("p_partkey", "p_type", F.lower("p_name").alias("exact"), F.lower(F.regexp_replace("p_name", " [^ ]+$", "")).alias("short"))
    out = resolve.resolve_labels(labels, index, ["p_type"], "name", [("exact", "exact"), ("stripped", "short")])
    return out.select("p_partkey", "outcome", "match")


NAME = "lower(p_name) || ' ' || p_size"
ALIAS = "split_part(lower(p_name), ' ', 2) || ' milwaukee ' || p_brand"
RAW = f"""CASE p_partkey % 9 WHEN 0 THEN upper({NAME}) WHEN 1 THEN p_name || '-' || p_size || ' High School' WHEN 2 THEN {NAME} || ' B' WHEN 3 THEN split_part(p_name, ' ', 2) || ' Milw. ' || p_brand
  WHEN 4 THEN lower(p_name) || ' ' || substr(CAST(p_size AS VARCHAR), 1, 1) WHEN 5 THEN split_part(p_name, ' ', 2) || ' ' || p_size WHEN 6 THEN split_part(p_name, ' ', 2) || ' Milw. ' || p_brand || ' a' WHEN 7 THEN 'Unknown ' || p_name ELSE split_part(p_name, ' ', 1) END"""


@query(f"""
WITH raws AS (SELECT p_partkey AS k, p_type AS place, {RAW} AS raw FROM part),
l AS (SELECT k, place, lower(raw) AS low, {NORMALIZE} AS name FROM raws),
m AS (SELECT k, place, replace(low, 'milw.', 'milwaukee') AS raw FROM l WHERE contains(low, 'milw.')),
w AS (SELECT k, place, {NORMALIZE} AS name FROM m),
keys AS (SELECT k, place, 1 AS step, 'exact' AS kind, name AS key FROM l UNION ALL SELECT k, place, 2, 'abbreviation', name FROM w
  UNION ALL SELECT k, place, 3, 'exact', name[:-3] FROM l WHERE regexp_full_match(name, '.+ .')
  UNION ALL SELECT w.k, w.place, 4, 'abbreviation', CASE WHEN regexp_full_match(w.name, '.+ .') THEN w.name[:-3] ELSE w.name END FROM w JOIN l USING (k) WHERE regexp_full_match(l.name, '.+ .')),
ents AS (SELECT p_type AS place, {NAME} AS name, {ALIAS} AS raw, p_partkey AS id FROM part),
ali AS (SELECT place, {NORMALIZE} AS name, id FROM ents),
names AS (SELECT place, name AS key, count(DISTINCT id) AS n, min(id) AS id FROM ents GROUP BY 1, 2),
idx AS (SELECT * FROM names UNION ALL SELECT place, name, count(DISTINCT id), min(id) FROM ali WHERE (place, name) NOT IN (SELECT (place, key) FROM names) GROUP BY 1, 2),
pl AS (SELECT k, place, CASE WHEN regexp_full_match(name, '.+ .') THEN name[:-3] ELSE name END AS key FROM l),
part_found AS (SELECT k, count(DISTINCT id) AS n, min(id) AS id FROM pl JOIN ents USING (place) WHERE contains(key, ' ') AND (ends_with(name, ' ' || key)
  OR (starts_with(name, key) AND starts_with(name, regexp_extract(key, '^(.+ )[^ ]+$', 1)) AND NOT contains(substr(name, length(regexp_extract(key, '^(.+ )[^ ]+$', 1)) + 1), ' '))) GROUP BY 1),
found AS (SELECT k, step, kind, n, id FROM keys JOIN idx USING (place, key) UNION ALL SELECT k, 99, 'partial', n, id FROM part_found),
f AS (SELECT k, arg_min(kind, step) AS kind, arg_min(n, step) AS n, arg_min(id, step) AS id FROM found GROUP BY 1)
SELECT l.k AS p_partkey, CASE WHEN f.k IS NULL THEN 'absent' WHEN n > 1 THEN 'ambiguous' ELSE kind END AS outcome, CASE WHEN n = 1 THEN id END AS id FROM l LEFT JOIN f ON l.k = f.k""")
def label_rules(spark, sf):
    """Printed labels of every form against names and aliases of their place, by all steps of the resolution."""
    p = load(spark, sf, "part")
    word = lambda k: F.split("p_name", " ")[k]
    name, size = F.concat(F.lower("p_name"), F.lit(" "), F.col("p_size").cast("string")), F.col("p_size").cast("string")
    alias = F.concat(F.lower(word(1)), F.lit(" milwaukee "), "p_brand")
    milw = F.concat(word(1), F.lit(" Milw. "), "p_brand")
    forms = [F.upper(name), F.concat("p_name", F.lit("-"), size, F.lit(" High School")), F.concat(name, F.lit(" B")), milw, F.concat(F.lower("p_name"), F.lit(" "), F.substring(size, 1, 1)), F.concat(word(1), F.lit(" "), size), F.concat(milw, F.lit(" a")), F.concat(F.lit("Unknown "), "p_name"), word(0)]
    entities = p.select(F.col("p_type").alias("place"), name.alias("name"), F.array(alias).alias("aliases"), F.col("p_partkey").alias("id"))
    raws = p.select(F.col("p_partkey").alias("row"), F.col("p_type").alias("place"), F.element_at(F.array(*forms), (F.col("p_partkey") % 9 + 1).cast("int")).alias("raw"))
    return labels.resolve(raws, entities).withColumnRenamed("row", "p_partkey")


@query("""
WITH t AS (SELECT p_type, p_brand, lower(p_name) AS name, p_partkey AS id FROM part),
l AS (SELECT p_partkey, p_type, p_brand, split_part(lower(p_name), ' ', 2) AS label FROM part),
c AS (SELECT p_partkey, count(DISTINCT id) AS n, min(id) AS id FROM l JOIN t ON l.p_type = t.p_type AND l.p_brand = t.p_brand AND ends_with(t.name, ' ' || l.label) AND t.id <> l.p_partkey GROUP BY 1)
SELECT l.p_partkey, CASE WHEN n IS NULL THEN 'unresolved' WHEN n = 1 THEN 'partial' ELSE 'ambiguous' END AS outcome, CASE WHEN n = 1 THEN c.id END AS match FROM l LEFT JOIN c USING (p_partkey)""")
def partial_label_join(spark, sf):
    """Each part's last word against the names of the others of its type and brand that end with it.

    A suffix match as an equi-join on the last word (blocking), never a theta join over all pairs: a block's
    own row is taken out of its count, least and second least.
    """
    p = load(spark, sf, "part").select("p_partkey", "p_type", "p_brand", F.lower("p_name").alias("name"))
    label = F.try_element_at(F.split("name", " "), F.lit(2))
    t = p.where(F.instr("name", " ") > 0).withColumn("label", F.substring_index("name", " ", -1)).groupBy("p_type", "p_brand", "label").agg(F.count("*").alias("n"), F.min("p_partkey").alias("low"), F.max("p_partkey").alias("high"))
    own = F.coalesce(((F.col("name") != label) & (F.substring_index("name", " ", -1) == label)).cast("int"), F.lit(0))
    l = p.withColumns({"label": F.coalesce(label, F.lit("")), "own": own}).join(t, ["p_type", "p_brand", "label"], "left").withColumn("others", F.coalesce("n", F.lit(0)) - F.col("own"))
    # one other: of two ends the one that isn't the row itself
    match = F.when(F.col("others") == 1, F.when(F.col("low") == F.col("p_partkey"), F.col("high")).otherwise(F.col("low")))
    return l.select("p_partkey", F.when(F.col("others") == 0, "unresolved").when(F.col("others") == 1, "partial").otherwise("ambiguous").alias("outcome"), match.alias("match"))


@query("""
WITH c AS (SELECT doc_id, source, lang, min(doc_id) OVER (PARTITION BY md5(text)) AS canonical FROM documents WHERE text IS NOT NULL)
SELECT canonical, count(*) AS members, 1 AS has_representative, CASE WHEN min(lang) = max(lang) THEN min(lang) END AS lang, string_agg(DISTINCT source, ',' ORDER BY source) AS source
FROM c GROUP BY 1""")
def set_union_collapse(spark, sf):
    """Rows with equal texts fold into their first; list fields are unioned."""
    d = load(spark, sf, "documents").where("text is not null").select("doc_id", "source", "lang", F.md5("text").alias("h"))
    agreed = F.when(F.min("lang") == F.max("lang"), F.min("lang"))
    sources = F.array_join(F.array_sort(F.collect_set("source")), ",")
    out = d.groupBy("h").agg(F.min("doc_id").alias("canonical"), F.count("*").alias("members"), agreed.alias("lang"), sources.alias("source"))
    return out.select("canonical", "members", F.lit(1).alias("has_representative"), "lang", "source")


@query("""
WITH strong AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 100) AS BIGINT) AS band FROM customer WHERE c_acctbal >= 0), weak AS (SELECT c_custkey AS weak, c_nationkey, c_mktsegment, CAST(floor(-c_acctbal / 10) AS BIGINT) AS band FROM customer WHERE c_acctbal < 0 OR c_acctbal IS NULL),
k AS (SELECT c_nationkey, c_mktsegment, band, count(DISTINCT c_custkey) AS n, min(c_custkey) AS t FROM strong GROUP BY 1, 2, 3)
SELECT weak, CASE WHEN n = 1 THEN t END AS target, CASE WHEN n IS NULL THEN 'kept' WHEN n = 1 THEN 'absorbed' ELSE 'kept_ambiguous' END AS note FROM weak LEFT JOIN k USING (c_nationkey, c_mktsegment, band)""")
def weak_key_collapse(spark, sf):
    """Customers in credit are strong rows, the others weak ones that claim their nation, segment and band."""
    c = load(spark, sf, "customer")
    band = lambda x: F.floor(x).cast("long").alias("band")
    strong = c.where("c_acctbal >= 0").select("c_custkey", "c_nationkey", "c_mktsegment", band(F.col("c_acctbal") / 100))
    weak = c.where("c_acctbal < 0 or c_acctbal is null").select(F.col("c_custkey").alias("weak"), "c_nationkey", "c_mktsegment", band(-F.col("c_acctbal") / 10))
    return resolve.collapse_weak(strong, weak, ["c_nationkey", "c_mktsegment", "band"], "c_custkey").select("weak", "target", "note")


def _pair_edges(spark, sf):
    """Parts that share name, type and size, or type, brand and size, as chains within each group."""
    from pyspark.sql import Window as W

    p = load(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    chain = lambda *by: p.select(F.col("p_partkey").alias("a"), F.lead("p_partkey").over(W.partitionBy(*by).orderBy("p_partkey")).alias("b")).where("b is not null")
    return chain("p_name", "p_type", "p_size").unionByName(chain("p_type", "p_brand", "p_size"))


@query("""
WITH RECURSIVE e0 AS (SELECT p_partkey AS a, lead(p_partkey) OVER (PARTITION BY p_name, p_type, p_size ORDER BY p_partkey) AS b FROM part
  UNION ALL SELECT p_partkey, lead(p_partkey) OVER (PARTITION BY p_type, p_brand, p_size ORDER BY p_partkey) FROM part),
e AS (SELECT a, b FROM e0 WHERE b IS NOT NULL UNION SELECT b, a FROM e0 WHERE b IS NOT NULL),
r(v, x) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a)
SELECT v, min(x) AS label FROM r GROUP BY v""")
def components(spark, sf):
    return resolve.components(_pair_edges(spark, sf)).select("v", "label")


@query("""
WITH RECURSIVE l AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_size < 40 AND p_partkey > 1),
r(id, target, n) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT r.id, l.dst, n + 1 FROM r JOIN l ON r.target = l.src)
SELECT id, arg_max(target, n) AS canonical, 'canonical' AS outcome FROM r GROUP BY id""")
def redirects(spark, sf):
    """Every part's canonical one; parts of size 40 and more, and the first, stand for themselves."""
    p = load(spark, sf, "part")
    links = p.where("p_size < 40 and p_partkey > 1").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).cast("long").alias("dst"))
    found = resolve.redirects(links).withColumnRenamed("id", "src")
    out = p.select(F.col("p_partkey").alias("src")).join(found, "src", "left")
    return out.select(F.col("src").alias("id"), F.when(F.col("outcome").isNull(), F.col("src")).otherwise(F.col("canonical")).alias("canonical"), F.coalesce("outcome", F.lit("canonical")).alias("outcome"))


@query("""
SELECT user_id, event_type, count(*) AS members, CASE WHEN min(event_type) OVER (PARTITION BY user_id) = max(event_type) OVER (PARTITION BY user_id) THEN 'decided' ELSE 'pending' END AS decision
FROM events GROUP BY user_id, event_type""")
def shared_object_clusters(spark, sf):
    """Rows naming the same object form a span: agreeing spans are decided, contradicting ones pend."""
    from pyspark.sql import Window as W

    by = W.partitionBy("user_id")
    c = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("members"))
    return c.withColumn("decision", F.when(F.min("event_type").over(by) == F.max("event_type").over(by), "decided").otherwise("pending"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def json_props(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), "event_type")


@query("SELECT page_id, coalesce(len(regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1)), 0) AS links, coalesce(len(regexp_extract_all(html, '<p>')), 0) AS paragraphs FROM pages")
def html_link_counts(spark, sf):
    p = load(spark, sf, "pages")
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return p.select("page_id", n(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))).alias("links"), n(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).alias("paragraphs"))


@query("SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1)) AS href FROM pages")
def html_links(spark, sf):
    return parsers.links(load(spark, sf, "pages"), "page_id", "html")


@query(r"""
WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS text FROM pages)
SELECT page_id, replace(replace(replace(replace(replace(replace(text, '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text FROM t""")
def html_text(spark, sf):
    return parsers.stripped(load(spark, sf, "pages"), "page_id", "html")


@query(r"""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages""")
def url_parts(spark, sf):
    u = load(spark, sf, "pages")
    return u.select("page_id", F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract("url", "^[a-z]+://[^/?#]+([^?#]*)", 1).alias("path"))


@query("""
WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, string_split(line, ' | ') AS cells FROM t WHERE contains(line, ' | '))
SELECT doc_id, count(*) AS table_lines, CAST(sum(len(cells)) AS BIGINT) AS cells FROM c GROUP BY 1""")
def delimited_tables(spark, sf):
    """Tables of ' | ' cells inside plain texts: lines, then cells."""
    return parsers.delimited(load(spark, sf, "documents"), "doc_id", "text", " | ").groupBy("doc_id").agg(F.count("*").alias("table_lines"), F.sum(F.size("cells")).alias("cells"))


@query(r"""SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[A-Za-z]')) AS mail FROM documents""")
def mailbox_rows(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[A-Za-z]"), F.lit(0))).alias("mail"))


# The twin's own list; it must not agree with the function by sharing its.
MAILS = ["a@gmail.com", "b@googlemail.com", "c@mail.me.com", "d@cox.net", "e@acox.net", "f@school.edu", "g@proton.me", "@x.org", "h@", "i@@x.org", " J@RR.com ", "k@host"]


@query(rf"""
WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[A-Za-z]')) AS mail FROM documents
  UNION ALL SELECT doc_id, (['{"', '".join(MAILS)}'])[doc_id % 12 + 1] FROM documents)
SELECT CASE WHEN NOT regexp_full_match(lower(trim(mail)), '[^@]+@[^@]+') THEN 'invalid'
  WHEN regexp_matches(split_part(lower(trim(mail)), '@', 2), '(^|[.])(gmail|googlemail|hotmail|outlook|live|msn|yahoo|aol|icloud|me|protonmail|ymail|mail|aim|juno|rr|frontier)[.]com$|(^|[.])proton[.]me$|(^|[.])(comcast|sbcglobal|att|verizon|earthlink|cox|windstream|centurytel)[.]net$') THEN 'consumer' ELSE 'institution' END AS class, count(*) AS n, count(DISTINCT mail) AS mails
FROM m GROUP BY 1""")
def email_class(spark, sf):
    """Classes of the addresses in documents and of a list that has each form."""
    listed = F.element_at(F.array(*map(F.lit, MAILS)), (F.col("doc_id") % 12 + 1).cast("int"))
    mails = mailbox_rows(spark, sf).unionByName(load(spark, sf, "documents").select("doc_id", listed.alias("mail")))
    return mails.groupBy(S.email_class("mail").alias("class")).agg(F.count("*").alias("n"), F.count_distinct("mail").alias("mails"))


@query("""
SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1""")
def conversation_shape(spark, sf):
    c = load(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">").alias("roles"), F.sum(F.length("text").cast("long")).alias("chars"))
    return c


@query("""
WITH m AS (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS k FROM events)
SELECT event_type, sha256(count(*) || ':' || CAST(sum(CAST('0x' || substr(md5(k), 1, 15) AS BIGINT)) AS VARCHAR)) AS digest, count(*) AS n FROM m GROUP BY 1""")
def scope_digest(spark, sf):
    """An order-free digest of each scope's members: their number and the sum of their hashes, so no list of them is gathered."""
    members = load(spark, sf, "events").select("event_type", F.col("user_id").cast("string").alias("k")).distinct()
    hashed = F.conv(F.substring(F.md5("k"), 1, 15), 16, 10).cast("decimal(38,0)")
    e = members.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(hashed).alias("h"))
    return e.select("event_type", F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("h").cast("string")), 256).alias("digest"), "n")
