"""The registered queries of this folder and the SQL of those it can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import chat, decontamination, html_text, language, mixing, neighbours, phrases, runs, scoring, simhash, substrings, topk, toxicity
from riskweave.llm.common import NOT_SPACE, read, remainder_of

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    told = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit(told).alias("content")) for r in ("user", "assistant")]).alias("messages"),
    )
    table = chat.canonical_turns(read(spark, sf_dir, "conversations"))
    formatted = chat.format_turns(table.unionByName(chat.canonical_turns(extra)))
    turns = F.transform(chat.turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read_back = formatted.select(
        "conv_id",
        turns.alias("turns"),
        chat.text_under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


QUERIES["op1_chat_format"] = op1_chat_format
ORACLE["op1_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '(</?s>|<</?SYS>>|\[/?INST\]|\[/?ROLE\])', '_\1', 'g') AS body,
         regexp_replace(replace(role, '\', '\\'), '(</?s>|<</?SYS>>|\[/?INST\]|\[/?ROLE\])', '_\1', 'g') AS name
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length(body) + CASE role WHEN 'user' THEN 20 WHEN 'system' THEN 22 WHEN 'assistant' THEN 7 ELSE 20 + length(name) END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that each document gives to a mix of the sources by weights 1, 2, 3."""
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source")


QUERIES["op2_mix_sources"] = op2_mix_sources
#: The mix as SQL over any relation with doc_id, text, source, and for any size of shards.
MIX_SQL = r"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('42-' || coalesce(doc_id::VARCHAR, '') || '-' || md5(coalesce(text, ''))) AS key FROM {docs}),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w,
         3.0::DOUBLE * sum(size)::BIGINT AS cap FROM sized GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total, sum(w) OVER () AS ws,
         coalesce(sum(cap) OVER b, 0) AS used, coalesce(sum(w) OVER b, 0) AS weighed FROM sources
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, cap * (ws - weighed) <= w * (total - used) AS stopped FROM ordered),
levels AS (
  SELECT *, coalesce(sum(CASE WHEN stopped THEN cap END) OVER (), 0) AS u, coalesce(sum(CASE WHEN stopped THEN w END) OVER (), 0) AS v FROM marked),
targets AS (SELECT source, source_size, CASE WHEN stopped THEN cap ELSE (total - u) * w / (ws - v) END AS target FROM levels),
seats AS (SELECT floor(sum(target) / 32 + 0.5)::BIGINT AS n FROM targets),
quotients AS (
  SELECT source, target / (2 * j - 1) AS quotient FROM targets, unnest(range(1, (source_size * 3 / 32)::BIGINT + 3)) AS t(j)),
ranked AS (SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS place FROM quotients),
won AS (SELECT t.source, count(r.place) AS blocks FROM targets t LEFT JOIN ranked r ON r.source IS NOT DISTINCT FROM t.source AND r.place <= (SELECT n FROM seats) GROUP BY t.source),
placed AS (
  SELECT s.*, t.source_size, t.target, w.blocks,
         CAST('0x' || substr(key, 1, 8) AS BIGINT) * greatest(ceil(t.source_size / {shard_words}.0::DOUBLE), 1)::BIGINT // 4294967296 AS shard
  FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source JOIN won w ON w.source IS NOT DISTINCT FROM s.source),
shards AS (SELECT source, shard, blocks, sum(size)::BIGINT AS words FROM placed GROUP BY ALL),
shard_quotients AS (SELECT source, shard, blocks, words::DOUBLE / (2 * j - 1) AS quotient FROM shards, unnest(range(1, (words * 3 / 32)::BIGINT + 3)) AS t(j)),
shard_ranked AS (SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) AS place FROM shard_quotients),
quotas AS (SELECT source, shard, count(*) AS quota FROM shard_ranked WHERE place <= blocks GROUP BY ALL),
cells AS (
  SELECT s.source, s.shard, words, least(coalesce(quota, 0) * 32, words * 3) AS due, CASE WHEN words > 0 THEN least(coalesce(quota, 0) * 32, words * 3) // words ELSE 0 END AS repeats
  FROM shards s LEFT JOIN quotas q ON q.source IS NOT DISTINCT FROM s.source AND q.shard = s.shard),
chosen AS (
  SELECT source, shard, block FROM cells, unnest(range(0, ceil(words / 32.0::DOUBLE)::BIGINT)) AS t(block)
  QUALIFY row_number() OVER (PARTITION BY source, shard ORDER BY md5('42-' || coalesce(source, '') || '-' || shard || '-' || block), block)
          <= floor((due - repeats * words) / 32.0::DOUBLE + 0.5)),
streamed AS (
  SELECT p.*, row_number() OVER () AS row_id,
         coalesce(sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.key, p.doc_id, p.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM placed p),
given AS (
  SELECT row_id, sum(least((b + 1) * 32, start + size) - greatest(b * 32, start)) AS part
  FROM (SELECT *, unnest(range(start // 32, (start + size - 1) // 32 + 1)) AS b FROM streamed WHERE size > 0) d
  JOIN chosen c ON c.source IS NOT DISTINCT FROM d.source AND c.shard = d.shard AND c.block = d.b GROUP BY row_id),
mixed AS (
  SELECT s.doc_id, s.size, s.source_size, s.target, (c.repeats * s.size + coalesce(g.part, 0))::BIGINT AS taken, s.source
  FROM streamed s LEFT JOIN given g USING (row_id) JOIN cells c ON c.source IS NOT DISTINCT FROM s.source AND c.shard = s.shard)
"""
ORACLE["op2_mix_sources"] = "WITH " + MIX_SQL.format(docs="documents", shard_words=mixing.SHARD_WORDS) + "SELECT doc_id, size, source_size, target, taken FROM mixed"


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document inside windows of benchmark items."""
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("digest")


QUERIES["op10_decontaminate"] = op10_decontaminate
WORDS_SQL = r"list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '')"
#: Contamination as SQL over any relation with doc_id and text (doc_id unique).
LEAK_SQL = """
doc_words AS (SELECT doc_id, {words} AS w FROM {docs}),
item_words AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {words} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM item_words, unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT l FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS t FROM doc_words, lengths, unnest(range(1, len(w) - l + 2)) AS u(i)),
spans AS (SELECT doc_id, i, d.l, item_id FROM doc_windows d JOIN item_windows b ON b.t = d.t AND b.l = d.l),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM spans, unnest(range(0, l)) AS u(k) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM spans) GROUP BY doc_id),
leaks AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
  FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN found f USING (doc_id))
"""
ORACLE["op10_decontaminate"] = "WITH " + LEAK_SQL.format(words=WORDS_SQL, docs="documents") + "SELECT * FROM leaks"


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of each text under the automaton of the texts that are not held out."""
    return scoring.score(read(spark, sf_dir, "documents"), remainder_of(F.col("doc_id"), 7) == 2)


QUERIES["op4_lm_score"] = op4_lm_score


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


QUERIES["op7_simhash_components"] = op7_simhash_components


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of each document by a machine of the labels that are not held out."""
    docs, held_out = read(spark, sf_dir, "documents"), remainder_of(F.col("doc_id"), 5) == 0
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"), held_out)
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document by a model of the texts that are not held out."""
    docs, held_out = read(spark, sf_dir, "documents"), remainder_of(F.col("doc_id"), 5) == 0
    model = language.fit(docs, held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES["op6_toxicity"] = op6_toxicity
QUERIES["op8_language"] = op8_language


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of the bytes of each document."""
    kept = substrings.deduplicate(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return kept.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES["op5_substring_dedup"] = op5_substring_dedup


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    found = html_text.main_text(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES["op3_main_text"] = op3_main_text


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest rows of each twentieth vector."""
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES["op9_nearest"] = op9_nearest


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) ends in 0 a tail of the words repeats.

    A null id has no crc32, so its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))

        def word(i: Column) -> Column:
            at = decontamination.bound(F.struct(a.alias("a"), p.alias("p")), lambda x: F.when(i >= x["a"], x["a"] + (i - x["a"]) % x["p"]).otherwise(i))
            return F.get(words, at.cast("int"))

        return F.array_join(F.transform(decontamination.positions(n), word), " ")

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(NOT_SPACE), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, decontamination.bound(words, planted)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of the words of each document, its text without them as digests."""
    found = runs.find_runs(with_planted_period(read(spark, sf_dir, "documents")))
    best = runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    whole = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return digests.select("doc_id", "n_runs", "best.start", "best.length", "best.period", whole, "runs_sha256", "collapsed_sha256")


QUERIES["op12_periodic_runs"] = op12_periodic_runs


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows with the largest integer product for each fiftieth vector."""
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


QUERIES["op11_topk"] = op11_topk
ORACLE["op11_topk"] = """
WITH integers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT row_number() OVER () AS q, vec_id AS query_id, v FROM integers WHERE vec_id % 50 = 0),
scored AS (
  SELECT q, query_id, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM asked a JOIN integers r ON len(a.v) = len(r.v) AND r.vec_id IS DISTINCT FROM a.query_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM scored)
WHERE rank <= 5
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2 000 best phrases of each language."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES["op13_collocations"] = op13_collocations
ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k::INT AS k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM worded, unnest([1, 2, 3, 4]) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(i)),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
known AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j::INT AS j, h.f AS l, t.f AS r, (2000000::HUGEINT * c.f) // (h.f + t.f) AS score
  FROM known c, unnest(range(1, c.k)) AS u(j)
  JOIN known h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:j], ' ')
  JOIN known t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[j + 1:c.k], ' ')
  WHERE c.k > 1),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS held
  FROM known, unnest([2, 3]) AS t(m), unnest(range(1, k - m + 2)) AS u(i) WHERE m < k GROUP BY ALL),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, score::BIGINT AS score
  FROM weakest w LEFT JOIN inner_parts p ON p.lang = w.lang AND p.phrase = w.phrase
  WHERE p.held IS NULL OR 100::HUGEINT * p.held < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
