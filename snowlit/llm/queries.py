"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowlit.llm import bpe, idfiles, mixing, packing, pii, preferences, prefixtrie, quality, runs, secrets, simhash, topk, warc
from snowlit.llm.common import stored
from snowlit.llm.tokens import tokenizer_path
from snowlit.operators.skew import hot_keys, split_join

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
QUERY_EVERY = 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "candidate", "score", "kept")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(pii.label_by_patterns(docs)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("reasons", ",").alias("reasons"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, 5)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    archives = stored(warc.write_archives(warc.assign_revisits(pages)), "archives")
    records = warc.read_archives(archives, payloads=False)
    return records.select(
        warc.page_of(F.col("record_id"), pages).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to"), pages).alias("refers_to"), "error",
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stored(idfiles.encode_shards(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), 0), "id-shards")
    return idfiles.documents_of(stored(idfiles.decode_shards(shards), "id-documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.format_pairs(preferences.sides_of(_table(spark, sf_dir, "conversations")))
    spans = F.array_join(F.transform("trained", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return pairs.withColumn("trained", spans)


def _decimal_crc(column) -> F.Column:
    """CRC-32 of a whole number in decimal."""
    return F.crc32(column.cast("string").cast("binary"))


def rebuilt_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns and the lengths of every conversation c, rebuilt so that many share prefixes:
    the first crc32(c) % 9 turns of conversation c - c % 5, then its own after as many."""
    turns = stored(prefixtrie.ordered_turns(conversations), "turns")
    takes = lambda c: _decimal_crc(c) % 9
    base = F.col("conv_id") - F.col("conv_id") % 5
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.select("conv_id", "n", takes(F.col("conv_id")).alias("h"), base.alias("base")), "conversation-sizes")
    heads = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    given = F.least("h", F.coalesce("base_n", F.lit(0)))
    cuts = sizes.join(heads, "base", "left").select(
        "conv_id", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    )
    cuts = stored(cuts, "conversation-cuts")
    hot = hot_keys(turns, "conv_id", max(prefixtrie.TURNS, turns.count() // prefixtrie.SPLITS))
    own = split_join(turns, cuts.drop("len"), "conv_id", ["pos"], hot).filter("pos >= h")
    own = own.withColumn("pos", F.col("given") + F.col("pos") - F.col("h")).select(*turns.columns)
    # A conversation gives at most 8 turns to at most 9 others.
    to = turns.filter("pos < 8 AND conv_id % 5 = 0").withColumn("k", F.explode(F.sequence(F.lit(-4), F.lit(4))))
    to = to.withColumns({"base": F.col("conv_id"), "conv_id": F.expr("try_add(conv_id, k)")})
    to = to.filter((base == F.col("base")) & (F.col("pos") < takes(F.col("conv_id")))).select(*turns.columns)
    rows = own.unionByName(to.join(cuts.select("conv_id"), "conv_id", "left_semi"))
    return stored(rows, "rebuilt-turns"), cuts.select("conv_id", "len")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, lengths = rebuilt_conversations(_table(spark, sf_dir, "conversations"))
    nodes = prefixtrie.with_ends(*prefixtrie.trie(turns, lengths))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256"
    )


def periodic_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which, by a hash of the id, one in ten goes on periodically
    from some word on. Rows without an id stay as they are."""
    h = _decimal_crc(F.col("doc_id"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    picked = docs.select(
        "doc_id", "text", F.floor(h / 10).cast("bigint").alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    )
    n = F.size("words").cast("bigint")
    start = F.col("g") % n
    placed = picked.select("doc_id", "text", "words", "g", F.when(n > 0, start).alias("a"), n.alias("n"))
    period = F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)).cast("bigint") + 1
    placed = placed.select("doc_id", "text", "words", "a", F.when(F.col("a").isNotNull(), period).alias("p"))
    repeated = F.transform(
        "words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(F.col("words"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    )
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(periodic_documents(_table(spark, sf_dir, "documents")))
    best = runs.best_run(F.col("runs"))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(runs.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_pii, op3_quality_rules, op4_packing, op5_top_k, op6_warc, op7_simhash, op8_token_ids,
        op9_bpe, op10_preferences, op11_prefix_trie, op12_periodic_runs, op13_source_mix, pipeline,
    )
}

# CRC-32 of the decimal conv_id, a bit at a time.
SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""
BLANKS = r"\x20\x09-\x0D"

ORACLES: dict[str, str] = {
    "op11_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, {SQL_CRC} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT DISTINCT conv_id FROM t)),
        moved AS (
            SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos < h
            UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h),
        rows AS (
            SELECT conv_id, row_number() OVER w AS depth, text,
                   list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY part, pos) AS path
            FROM moved WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
            UNION ALL SELECT conv_id, 0, '', [] FROM c),
        lengths AS (SELECT conv_id, max(depth) AS len FROM rows GROUP BY conv_id),
        nodes AS (
            SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(octet_length(encode(text))) AS n_bytes,
                   coalesce(string_agg(CASE WHEN depth = len THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
            FROM rows JOIN lengths USING (conv_id) GROUP BY depth, path),
        kids AS (
            SELECT p.depth, p.path, count(*) AS n_children
            FROM nodes AS p JOIN nodes AS k ON k.depth = p.depth + 1 AND k.path[:p.depth] = p.path GROUP BY ALL),
        whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes AS n LEFT JOIN kids USING (depth, path)),
        below AS (
            SELECT a.depth, a.path, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
                   sum((u.n_convs - 1) * u.n_bytes) AS saved
            FROM whole AS a JOIN whole AS u ON u.depth >= a.depth AND u.path[:a.depth] = a.path GROUP BY ALL)
        SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
               b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
        FROM whole AS w JOIN below AS b USING (depth, path)
        LEFT JOIN nodes AS p ON p.depth = w.depth - 1 AND p.path = w.path[:w.depth - 1]
    """,
    "op13_source_mix": f"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+')) AS size,
                   len(regexp_extract_all(coalesce(text, ''), '(^|[{BLANKS}])\\p{{L}}')) AS letters,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 13) AS BIGINT) AS u
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
            FROM d GROUP BY source),
        o AS (
            SELECT *, 3 * source_size AS bound, sum(source_size) OVER () AS total,
                   coalesce(sum(3 * source_size) OVER before, 0) AS bounds, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS share
            FROM s WINDOW before AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
            SELECT min_by(total - bounds, bounds) AS rest, min_by(share, bounds) AS share
            FROM o WHERE bound * share >= w * (total - bounds)),
        t AS (
            SELECT source, source_size, least(CAST(bound AS DOUBLE), CAST(w * rest AS DOUBLE) / CAST(level.share AS DOUBLE)) AS target
            FROM o, level),
        k AS (
            SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS words,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln((u + 1) / 4503599627370496.0) / ((letters + 1.0::DOUBLE) / (size + 1.0::DOUBLE)), doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
                   + least(greatest(words - (words // source_size) * source_size - before, 0), size) END AS BIGINT) AS taken
        FROM k
    """,
    "op5_top_k": f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
            WHERE q.vec_id % {QUERY_EVERY} = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM scored)
        SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM ranked WHERE nth <= 5
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
        m AS (SELECT p.*, CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM p JOIN g USING (h))
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
               CAST(NULL AS VARCHAR) AS error
        FROM m
    """,
    "op10_preferences": f"""
        WITH replies AS (
            SELECT conv_id, arg_min(text, turn) AS first_reply, max(turn) AS last_turn
            FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
        turns AS (SELECT c.*, first_reply, last_turn FROM conversations AS c LEFT JOIN replies USING (conv_id)),
        sides AS (
            SELECT conv_id AS pair_id, true AS chosen, turn, role, text FROM turns
            UNION ALL
            SELECT conv_id, false, turn, role,
                   CASE WHEN role = 'assistant' AND turn = last_turn THEN first_reply ELSE text END FROM turns),
        g AS (
            SELECT pair_id, turn, role, text, bool_or(chosen) AS c, bool_or(NOT chosen) AS r
            FROM sides GROUP BY pair_id, turn, role, text),
        ends AS (SELECT pair_id, min(turn) AS stop FROM g WHERE NOT (c AND r) GROUP BY pair_id),
        parts AS (
            SELECT g.*, CAST(floor(turn / {preferences.BLOCK_TURNS}) AS BIGINT) AS block,
                   unnest(CASE WHEN stop IS NULL OR turn < stop THEN ['prompt']
                          WHEN c AND r THEN ['chosen', 'rejected'] WHEN c THEN ['chosen'] ELSE ['rejected'] END) AS part,
                   '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
            FROM g LEFT JOIN ends USING (pair_id)),
        placed AS (
            SELECT *, coalesce(sum(length(piece)) OVER (
                PARTITION BY pair_id, part, block ORDER BY turn, role, text
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
            FROM parts),
        written AS (
            SELECT pair_id, part, block, string_agg(piece, '' ORDER BY turn, role, text) AS text,
                   coalesce(string_agg(CASE WHEN part <> 'prompt' AND role = 'assistant'
                       THEN (pos + 5 + length(role)) || ':' || (pos + length(piece) - 1) END, ',' ORDER BY turn, role, text), '') AS trained
            FROM placed GROUP BY pair_id, part, block)
        SELECT pair_id, part, block, CAST(coalesce(sum(length(text)) OVER (
                   PARTITION BY pair_id, part ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
               text, trained
        FROM written
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
