"""Queries of dictionaries in texts and of profiles put together from them. Items come from parts, texts from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from evidar.functions.text import is_cjk_key, lower_alnum
from evidar.operators import lexicon, matching, profiles
from evidar.plans.registry import query
from evidar.sources.stages import staged
from evidar.sources.tables import table

# Expressions that mean the same in both dialects.
HAN = "translate(lpad(CAST({0} AS VARCHAR(9)), 5, '0'), '0123456789', '零一二三四五六七八九')"
WIDE = "translate(CAST({0} AS VARCHAR(9)), '0123456789', '０１２３４５６７８９')"
ITEM = {
    "item_id": "p_partkey", "en": "concat(p_name, ' ', CAST(p_partkey % 97 AS VARCHAR(9)))", "zh": HAN.format("p_partkey"), "nick": "concat(p_brand, CAST(p_size AS VARCHAR(9)))",
    "verification_status": "CASE WHEN p_partkey % 3 = 0 THEN 'verified' ELSE 'needs_review' END", "model_feature_status": "CASE WHEN p_partkey % 6 < 3 THEN 'eligible' ELSE 'excluded_pending_verification' END",
    "kind": "CASE WHEN p_partkey % 5 = 0 THEN 'set' ELSE 'item' END", "target_id": "p_partkey + 1", "spelled": "CASE WHEN p_partkey % 2 = 0 THEN concat(p_type, CAST(p_partkey % 500 AS VARCHAR(9))) ELSE substr(p_name, 1, 2) END",
    "verified": "p_partkey % 4 < 2", "ultimate_reward": "p_size % 7 = 0", "collaboration": "p_type = 'ECONOMY'", "source_type": "CASE WHEN p_size % 3 = 0 THEN 'event' ELSE 'season' END",
    "availability_status": "CASE WHEN p_partkey % 4 = 0 THEN 'limited_time' WHEN p_partkey % 4 = 1 THEN 'available' WHEN p_partkey % 4 = 2 THEN 'officially_discontinued' END",
}
ITEMS_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in ITEM.items()) + " FROM part"
LISTED = {
    "id": "doc_id", "account_offer": "CASE WHEN doc_id % 11 = 0 THEN 'mixed' ELSE 'seller_listing' END", "offer_kind": "CASE WHEN doc_id % 13 = 0 THEN 'mixed' ELSE 'seller_listing' END", "entity_kind": "CASE WHEN doc_id % 17 = 0 THEN 'bundle' ELSE 'single_account' END",
    "listing_text": "concat(coalesce(text, ''), '。', CASE doc_id % 4 WHEN 0 THEN '沒有' WHEN 1 THEN '不含' ELSE '' END, a.en, '，', a.zh, '、', CASE WHEN doc_id % 5 = 0 THEN '缺' ELSE '' END, b.nick, b.spelled)",
    "summary": "concat(CASE WHEN doc_id % 6 = 0 THEN '無' ELSE '' END, a.en, ' ', b.zh)",
}
LISTED_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in LISTED.items()) + f" FROM documents, ({ITEMS_SQL}) a, ({ITEMS_SQL}) b WHERE a.item_id = doc_id % 200 AND b.item_id = doc_id * 7 % 200"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr(*[f"{v} AS {k}" for k, v in ITEM.items()])
    return rows.withColumns({"names": F.array("zh", "en"), "aliases": F.array("nick"), "canonical_name_en": F.col("en")})


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).select(F.col("kind").alias("target_type"), "target_id", F.col("spelled").alias("alias_text"), "verified")


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.broadcast(items(spark, sf_dir).where("abs(item_id) < 200"))  # no others are asked for
    docs = table(spark, sf_dir, "documents").withColumns({"a_id": F.expr("doc_id % 200"), "b_id": F.expr("doc_id * 7 % 200")})
    return docs.join(own.alias("a"), F.col("a_id") == F.col("a.item_id")).join(own.alias("b"), F.col("b_id") == F.col("b.item_id")).selectExpr(*[f"{v} AS {k}" for k, v in LISTED.items()])


NORMAL = "lower(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
ALIAS_SQL = f"""
i AS ({ITEMS_SQL}),
said AS (SELECT item_id, zh AS s, 2 AS shortest FROM i UNION ALL SELECT item_id, en, 2 FROM i UNION ALL SELECT item_id, nick, 3 FROM i
  UNION ALL SELECT target_id, spelled, CASE WHEN verified THEN 2 ELSE 3 END FROM i WHERE kind = 'item' AND target_id IN (SELECT item_id FROM i)),
aliases AS (SELECT alias, min(item_id) AS item_id FROM (SELECT {NORMAL.format('s')} AS alias, item_id, shortest FROM said) WHERE length(alias) >= shortest GROUP BY alias HAVING count(DISTINCT item_id) = 1)"""


@query("alias_dictionary", f"WITH {ALIAS_SQL} SELECT alias, item_id FROM aliases")
def alias_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.alias_table(items(spark, sf_dir), master(spark, sf_dir)).select("alias", "item_id")


def hits_sql(texts: str, keys: str, window: int, order: str, clash: str) -> str:
    """CTEs h (all places), k (what stays): a text is split at each key that it holds."""
    return f"""
n AS ({texts}), f AS (SELECT n.id, n.source, n.t, d.alias, string_split(n.t, d.alias) AS parts FROM n, ({keys}) d WHERE contains(n.t, d.alias)),
p AS (SELECT id, source, t, alias, unnest(range(1, len(parts))) AS j, parts FROM f),
h AS (SELECT id, source, alias, list_sum(list_transform(parts[1:j], lambda x: length(x)))::BIGINT + (j - 1) * length(alias) AS a, t FROM p),
q AS (SELECT id, source, list({{'a': a, 'e': a + length(alias), 's': alias, 'b': t[greatest(a - {window}, 0) + 1:a]}} ORDER BY {order}) AS hits FROM h GROUP BY id, source),
k AS (SELECT id, source, unnest(list_reduce(list_transform(hits, lambda x: [x]), lambda acc, x: CASE WHEN {clash} THEN acc ELSE list_concat(acc, x) END)) AS hit FROM q)"""


LONGEST = ("-length(alias), a, alias", "len(list_filter(acc, lambda c: c.a < x[1].e AND x[1].a < c.e)) > 0")
LEFTMOST = ("a, -length(alias), alias", "x[1].a < acc[len(acc)].e")
NEGATED = "regexp_matches(hit.b, '(?:" + "|".join(matching.NEGATION_PREFIXES) + ")$')"
TEXTS_SQL = f"SELECT id, 'listing_text' AS source, {NORMAL.format('listing_text')} AS t FROM l UNION ALL SELECT id, 'feature_summary', {NORMAL.format('summary')} FROM l"
EVIDENCE_SQL = f"""{ALIAS_SQL}, l AS ({LISTED_SQL}), {hits_sql(TEXTS_SQL, 'SELECT alias FROM aliases', 6, *LONGEST)},
ev AS (SELECT id, item_id, list_sort(list(DISTINCT alias)) AS aliases, list_sort(list(DISTINCT source)) AS sources, bool_or(NOT neg) AS positive, bool_or(neg) AS negative
  FROM (SELECT id, source, hit.s AS alias, {NEGATED} AS neg FROM k) JOIN aliases USING (alias) GROUP BY id, item_id)"""


def both_texts(rows: DataFrame, summary: str = "feature_summary", normal=lower_alnum) -> DataFrame:
    pair = F.explode(F.array(F.struct(F.lit("listing_text").alias("source"), F.col("listing_text").alias("said")), F.struct(F.lit(summary).alias("source"), F.col("summary").alias("said")))).alias("x")
    return rows.select("id", pair).select("id", "x.source", normal(F.col("x.said")).alias("text"))


def evidence(spark: SparkSession, sf_dir: str, most: int = lexicon.BROADCAST_CHARS) -> DataFrame:
    aliases = staged(lexicon.alias_table(items(spark, sf_dir), master(spark, sf_dir)), "aliases")
    hits = lexicon.settled(lexicon.occurrences(both_texts(listed(spark, sf_dir)), aliases, most=most), matching.LONGEST_FIRST)
    return lexicon.text_evidence(hits, aliases.withColumnRenamed("item_id", "owner"))


@query("dictionary_evidence", f"WITH {EVIDENCE_SQL} SELECT id, item_id, array_to_string(aliases, ',') AS aliases, array_to_string(sources, ',') AS sources, positive, negative FROM ev")
def dictionary_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence(spark, sf_dir).select("id", F.col("owner").alias("item_id"), F.array_join("aliases", ",").alias("aliases"), F.array_join("sources", ",").alias("sources"), "positive", "negative")


@query("dictionary_evidence_dealt", f"WITH {EVIDENCE_SQL} SELECT id, item_id, array_to_string(aliases, ',') AS aliases, positive, negative FROM ev")
def dictionary_evidence_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, the dictionary joined as one too large for a task would be."""
    return evidence(spark, sf_dir, most=0).select("id", F.col("owner").alias("item_id"), F.array_join("aliases", ",").alias("aliases"), "positive", "negative")


STATES_SQL = f"""{EVIDENCE_SQL},
pr AS (SELECT l_orderkey AS id, l_partkey AS item_id, bool_or(l_returnflag = 'N') AS owned, bool_or(l_returnflag = 'R') AS missing FROM lineitem WHERE l_orderkey IN (SELECT doc_id FROM documents) GROUP BY ALL),
m AS (SELECT coalesce(ev.id, pr.id) AS id, coalesce(ev.item_id, pr.item_id) AS item_id, coalesce(owned, false) AS po, coalesce(missing, false) AS pm, coalesce(positive, false) AS tp, coalesce(negative, false) AS tn,
  coalesce(aliases, []) AS aliases, coalesce(sources, []) AS sources FROM ev FULL JOIN pr ON ev.id = pr.id AND ev.item_id = pr.item_id),
s AS (SELECT m.*, model_feature_status AS fs, verification_status = 'verified' AND model_feature_status = 'eligible' AS el,
  verification_status = 'verified' AND model_feature_status = 'eligible' AND list_contains(aliases, {NORMAL.format('en')}) AS ap FROM m JOIN i USING (item_id)),
v AS (SELECT *, CASE WHEN el THEN tp AND ap ELSE po OR tp END AS pos, CASE WHEN el THEN tn AND ap ELSE pm OR tn END AS neg FROM s),
w AS (SELECT *, CASE WHEN el THEN (pos AND (pm OR tn)) OR (neg AND (po OR tp)) ELSE pos AND neg END AS conflict FROM v),
z AS (SELECT *, CASE WHEN conflict THEN 'unknown' WHEN pos THEN 'owned' WHEN neg THEN 'confirmed_missing' ELSE 'unknown' END AS state FROM w)"""


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "documents").select("doc_id"), F.col("l_orderkey") == F.col("doc_id"), "left_semi").groupBy(
        F.col("l_orderkey").alias("account_id"), F.col("l_partkey").alias("item_id")).agg(F.bool_or(F.col("l_returnflag") == "N").alias("owned"), F.bool_or(F.col("l_returnflag") == "R").alias("missing"))
    own = items(spark, sf_dir)
    return matching.item_states(lexicon.vector_inputs(evidence(spark, sf_dir), owned, own, lexicon.approved_tokens(own)))


@query("text_item_states", f"WITH {STATES_SQL} SELECT id AS account_id, item_id, state, conflict, el AND state <> 'unknown' AND NOT conflict AS model_feature FROM z")
def text_item_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select("account_id", "item_id", "state", "conflict", "model_feature")


@query("parser_summaries", f"""WITH {STATES_SQL}
SELECT d.doc_id AS account_id, (SELECT count(*) FROM part) AS catalog_items, count_if(el AND state <> 'unknown' AND NOT conflict) AS approved_items,
  count_if(NOT (el AND state <> 'unknown' AND NOT conflict) AND fs = 'excluded_pending_verification') AS named_for_review, count_if(len(aliases) > 0) AS text_items, count_if(list_contains(sources, 'listing_text')) AS listing_text_items,
  count_if(list_contains(sources, 'feature_summary')) AS feature_summary_items, count_if(po) AS profile_owned_items, count_if(pm) AS profile_missing_items, count_if(conflict) AS conflict_items
FROM documents d LEFT JOIN z ON z.id = d.doc_id GROUP BY d.doc_id""")
def parser_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("account_id"))
    return lexicon.parser_summary(states(spark, sf_dir), accounts, table(spark, sf_dir, "part").count())


SIDE_KEYS = f"SELECT key, min(p_partkey) AS owner FROM (SELECT {HAN.format('p_partkey')} AS key, p_partkey FROM part UNION ALL SELECT {HAN.format('p_partkey % 1000 + 50000')}, p_partkey FROM part) WHERE key NOT LIKE '零零%' GROUP BY key HAVING count(DISTINCT p_partkey) = 1"
SIDE_NEGATED = "regexp_matches(hit.b, '(?:" + "|".join(lexicon.SIDECAR_NEGATIONS) + ")$')"


@query("lexical_sidecar", f"""WITH l AS ({LISTED_SQL}), d AS ({SIDE_KEYS}),
{hits_sql(TEXTS_SQL, 'SELECT key AS alias FROM d', 4, *LEFTMOST)},
m AS (SELECT id, owner, CASE WHEN bool_or(neg) AND bool_or(NOT neg) THEN 'conflict' WHEN bool_or(neg) THEN 'negative' ELSE 'positive' END AS assertion
  FROM (SELECT id, hit.s AS key, {SIDE_NEGATED} AS neg FROM k) JOIN d USING (key) GROUP BY id, owner),
g AS (SELECT id, string_agg(owner || ':' || assertion, ',' ORDER BY owner) AS found FROM m GROUP BY id),
e AS (SELECT l.*, account_offer = offer_kind AND offer_kind = 'seller_listing' AND entity_kind = 'single_account' AS ok FROM l)
SELECT e.id AS account_id, CASE WHEN ok THEN 'eligible' ELSE 'suppressed_not_seller_single_account' END AS matching_eligibility, upper(sha256(listing_text)) AS listing_text_sha256,
  upper(sha256('["' || summary || '"]' || chr(10))) AS feature_summary_sha256, CASE WHEN ok THEN coalesce(found, '') ELSE '' END AS matches FROM e LEFT JOIN g ON g.id = e.id""")
def lexical_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    index = parts.selectExpr(f"{HAN.format('p_partkey')} AS key", "p_partkey AS owner").unionByName(parts.selectExpr(f"{HAN.format('p_partkey % 1000 + 50000')} AS key", "p_partkey AS owner"))
    keys = staged(lexicon.distinct_keys(index, is_cjk_key(F.col("key")) & ~F.col("key").startswith("零零")), "keys")
    rows = listed(spark, sf_dir)
    hits = lexicon.settled(lexicon.occurrences(both_texts(rows), keys.withColumnRenamed("key", "alias"), lexicon.SIDECAR_WINDOW), matching.LEFTMOST_LONGEST)
    accounts = rows.select(F.col("id").alias("account_id"), F.array("id").alias("listing_ids"), F.col("account_offer").alias("offer_kind"), "entity_kind")
    given = rows.select(F.col("id").alias("listing_id"), "offer_kind", "entity_kind", "listing_text", F.array("summary").alias("feature_summary"))
    found = lexicon.sidecar(accounts, given, hits, keys.withColumnRenamed("key", "alias"))
    said = F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["owner"].cast("string"), m["assertion"])), ",")
    return found.select("account_id", "matching_eligibility", "listing_text_sha256", "feature_summary_sha256", said.alias("matches"))


@query("collection_subsets", f"""
WITH i AS ({ITEMS_SQL}), o AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS item_id FROM lineitem WHERE l_returnflag = 'N'),
b AS (SELECT item_id FROM i, (SELECT DISTINCT 'set' || s_suppkey AS set_id FROM supplier WHERE s_nationkey % 3 = 0) WHERE set_id = 'set' || item_id % 50),
j AS (SELECT id, o.item_id AS n, i.item_id IS NOT NULL AND ultimate_reward AS u, i.item_id IS NOT NULL AND collaboration AS c, o.item_id IN (SELECT item_id FROM b) AS s,
  coalesce(source_type = 'event' AND availability_status IN ('limited_time', 'temporarily_unavailable', 'officially_discontinued'), false) AS v FROM o LEFT JOIN i USING (item_id))
SELECT id, string_agg(n::VARCHAR, ',' ORDER BY n) AS owned, coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (u), '') AS graduation, coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (c), '') AS collaboration,
  coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (s), '') AS bundles, coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (v), '') AS limited FROM j GROUP BY id""")
def collection_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("item_id"), F.array(F.lit("listing_text")).alias("sources")).distinct()
    own = items(spark, sf_dir).withColumn("set_ids", F.array(F.concat(F.lit("set"), (F.col("item_id") % 50).cast("string"))))
    sets = table(spark, sf_dir, "supplier").select(F.concat(F.lit("set"), F.col("s_suppkey").cast("string")).alias("set_id"), F.when(F.col("s_nationkey") % 3 == 0, "bundle").otherwise("outfit").alias("set_type"))
    found = profiles.collection_subsets(owned, own, sets)
    join = lambda c, n: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(n)
    return found.select("id", join("owned_item_ids", "owned"), join("graduation_rewards", "graduation"), join("collaboration_items", "collaboration"), join("bundle_item_ids", "bundles"), join("event_limited_item_ids", "limited"))


# A listing of each order: what its text and its summary say is made of its numbers, in digits of either width and white space of either kind.
N = "(o_orderkey % 900 + 100)"
CLAIMED = {
    "said": "concat(CASE o_orderkey % 5 WHEN 0 THEN '白蠟" + "　' WHEN 1 THEN '白蜡燭：約 ' WHEN 2 THEN '白蠟 ' WHEN 3 THEN '愛心' ELSE '無此' END, " + WIDE.format(N) + ", CASE o_orderkey % 7 WHEN 0 THEN '以上' WHEN 1 THEN '　起' ELSE '，' END, "
            "CASE o_custkey % 4 WHEN 0 THEN '第　2　任' WHEN 1 THEN '第1手' WHEN 2 THEN '第十二任' ELSE '自創' END, CASE o_orderkey % 3 WHEN 0 THEN '；Google、Apple 可出' WHEN 1 THEN '；GG死綁' ELSE '；' END, CASE WHEN o_custkey % 5 = 0 THEN '全圖畢' ELSE '' END)",
    "summary": "concat(CASE o_orderkey % 4 WHEN 0 THEN '白蠟 ' WHEN 1 THEN '' ELSE '愛心：' END, CAST(CASE WHEN o_custkey % 3 = 0 THEN " + N + " ELSE 7 END AS VARCHAR(9)), '。', CASE o_custkey % 6 WHEN 0 THEN '二手' WHEN 1 THEN '一手' ELSE '' END, "
               "CASE WHEN o_orderkey % 5 = 0 THEN ' FB不出' ELSE ' Google可換綁' END)",
    "offer_kind": "CASE WHEN o_orderkey % 10 = 0 THEN 'mixed' ELSE 'seller_listing' END",
}
CLAIMED_SQL = "SELECT o_orderkey, o_custkey, " + ", ".join(f"{v} AS {k}" for k, v in CLAIMED.items()) + " FROM orders"


def claimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", *[f"{v} AS {k}" for k, v in CLAIMED.items()])


def _amount(column: str, word: str) -> str:
    """The number after the word in SQL, which has no look-ahead: what follows the digits is asked of the rest."""
    wide = f"translate({column}, '０１２３４５６７８９　', '0123456789 ')"
    found = f"regexp_extract({wide}, '(?:{word})[:：]? *(?:約)? *([0-9]+)', 1)"
    open_ = f"regexp_matches({wide}, '(?:{word})[:：]? *(?:約)? *[0-9]+ *(?:以上|起)')"
    return f"CASE WHEN {open_} THEN NULL WHEN {found} <> '' THEN {found}::BIGINT END"


WHITE_WORD, HEARTS_WORD = "白蠟|白蜡燭", "愛心"
MERGE = "CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL OR {a} = {b} THEN {a} END"
PROFILE_SQL = f"""
t AS (SELECT *, CASE WHEN offer_kind = 'seller_listing' THEN said ELSE '' END AS x, CASE WHEN offer_kind = 'seller_listing' THEN summary ELSE '' END AS y FROM ({CLAIMED_SQL})),
r AS (SELECT *, {_amount('x', WHITE_WORD)} AS wx, {_amount('y', WHITE_WORD)} AS wy, {_amount('x', HEARTS_WORD)} AS hx, {_amount('y', HEARTS_WORD)} AS hy,
  CASE WHEN x = '' THEN NULL WHEN x LIKE '%第　2　任%' THEN 'second_owner' WHEN x LIKE '%第1手%' THEN 'first_owner' WHEN x LIKE '%自創%' THEN 'first_owner' END AS ox,
  CASE WHEN y LIKE '%二手%' THEN 'second_owner' WHEN y LIKE '%一手%' THEN 'first_owner' END AS oy,
  CASE WHEN x LIKE '%GG死綁%' THEN 'high_risk' WHEN x LIKE '%Google%' THEN 'available' END AS gx, CASE WHEN y LIKE '%Google可換綁%' THEN 'available' END AS gy FROM t),
c AS (SELECT *, coalesce(wx <> wy, false) AS wc, coalesce(hx <> hy, false) AS hc, coalesce(ox <> oy, false) AS oc, coalesce(gx <> gy, false) AS gc FROM r)"""


@query("text_profiles", f"""WITH {PROFILE_SQL}
SELECT o_orderkey, {MERGE.format(a='wx', b='wy')} AS white_candles, {MERGE.format(a='hx', b='hy')} AS hearts,
  CASE WHEN wc OR hc THEN 'conflict' WHEN coalesce(wx, wy, hx, hy) IS NOT NULL THEN 'text_claim' ELSE 'unknown' END AS resource_evidence,
  coalesce({MERGE.format(a='ox', b='oy')}, 'unknown') AS ownership, coalesce({MERGE.format(a='gx', b='gy')}, CASE WHEN gc THEN 'unknown' ELSE 'unknown' END) AS google,
  CASE WHEN x LIKE '%全圖畢%' THEN 'complete' ELSE 'unknown' END AS standard_maps, CASE WHEN wc OR hc OR oc OR gc THEN 'needs_review' ELSE 'unknown' END AS review_status FROM c""")
def text_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claimed(spark, sf_dir).select(
        F.col("o_orderkey").alias("listing_id"), F.col("o_custkey").alias("account_id"), "offer_kind", F.lit("single_account").alias("entity_kind"), F.col("said").alias("listing_text"), F.array("summary").alias("feature_summary"),
        F.create_map(F.lit("none"), F.lit("none")).alias("known_bindings"), F.lit("clean_claimed").alias("binding_risk"))
    own = items(spark, sf_dir)
    names = lexicon.alias_table(own, master(spark, sf_dir)).select("alias", F.lit("item").alias("target_type"), F.col("item_id").alias("target_id"))
    sets = table(spark, sf_dir, "supplier").select(F.lit("set").alias("set_id"), F.lit("outfit").alias("set_type"))
    made = profiles.profiles(rows, {"破曉": "shattering"}, {"shattering": 1}, staged(names, "names"), own.withColumn("set_ids", F.array(F.lit("set"))), sets)
    google = F.element_at(F.filter("bindings", lambda b: b["platform"] == "google"), 1)["status"]
    return made.select(
        F.col("listing_id").alias("o_orderkey"), F.col("resources.values.white_candles").alias("white_candles"), F.col("resources.values.hearts").alias("hearts"), F.col("resources.evidence_state").alias("resource_evidence"),
        F.col("ownership_history.value").alias("ownership"), google.alias("google"), F.col("maps.standard_maps.value").alias("standard_maps"), "review_status")
