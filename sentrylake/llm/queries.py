"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, interval_join, licenses, media, mixing, ngram_join, packing, pieces, quality, resampling, sharding, toxicity
from .common import map_texts, utf8_size
from .labelled import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model(spark: SparkSession, path: str | None = None) -> bytes:
    """The bytes of a tokenizer's model, read on the driver; tasks get them with their code."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encode_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id and digests of the ids (with an end id) and of what they decode to, for each row.

    Null texts count as empty, null ids stay, repeated rows come out repeated, an empty frame gives no rows, other columns are dropped.
    """

    def make():
        codec = pieces.PieceCodec(model)
        spelled = [str(i) for i in range(len(codec.shown))]

        def digest(text):
            ids = codec.encode(text)
            ids.append(codec.eos)
            line = " ".join(map(spelled.__getitem__, ids))
            decoded = codec.decode(ids)
            return len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        return digest

    return map_texts(docs.select("doc_id", "text"), ["doc_id"], make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), piece_model(spark))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


#: A document with at least this score counts as of class 1.
THRESHOLD = 0.3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, ["doc_id"], model)
    return scored.select("doc_id", held_out(F.col("doc_id"), *toxicity.HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per row of documents. Null texts are empty and stored as 64 zero bytes, null ids stay, texts of any length are stored whole, repeated rows and equal texts give equal values, an
    empty table gives no rows; only doc_id and text are read, so other columns may have any name."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def make():
        automaton = media.signature_automaton()

        def run(text):
            raw = (text or "").encode()
            stored = media.to_wav(media.padded(raw))
            kind, corrected, start, end, inside = media.inspect(stored, "application/octet-stream", automaton)
            read = stored[start:end]
            return len(raw), len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), media.features(kind, read, len(inside)), kind, corrected

        return run

    return map_texts(docs, ["doc_id"], make, "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, true_type string, corrected boolean")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_texts(docs, ["doc_id"], model)
    return scored.select("doc_id", held_out(F.col("doc_id"), *quality.HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    kinds = dict(turns.dtypes)
    probe = "</s>[INST] ok [/INST]"
    values = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise("assistant"), "text": F.lit(probe)}
    planted = spark.range(2).select(*[v.cast(kinds[c]).alias(c) for c, v in values.items()])
    return chat.read_back(chat.expand_replies(turns.select("conv_id", "turn", "role", "text").unionByName(planted)))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = sharding.stored_shards(table(spark, sf_dir, "documents"), 8)
    size = (utf8_size(F.col("text")) + 1).alias("size")
    text_crc32 = F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32")
    return stored.select("doc_id", size, text_crc32, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per row of documents. Null and empty texts have no words and no labels, null ids stay, texts of any length are scanned whole, repeated rows give equal rows, an empty table gives none;
    only doc_id and text are read, so other columns may have any name."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def make():
        scanner = licenses.LicenseScanner()

        def run(text):
            n, hits = scanner.scan(text)
            base = [h for h in hits if h.base]
            first = [h.first for h in base]
            names = lambda hits: ",".join(sorted({h.label for h in hits}))
            return n, len(base), min(first, default=None), max(first, default=None), names(base), names(hits), licenses.confidence(n, hits)

        return run

    return map_texts(docs, ["doc_id"], make, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def byte_vocabulary() -> tuple[str, bytes]:
    """The byte-level vocabulary as the tokenizers library reads it, and as ranks; tasks get both with their code."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as ranks:
        return f.read(), ranks.read()


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *byte_vocabulary())


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("text"))


def op13_interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interval_join.sessions(interval_join.click_events(table(spark, sf_dir, "clicks")))
    of = interval_join.sale_intervals(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"))
    return interval_join.overlap_totals(of, found).withColumnRenamed("id", "sale_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_media": op4_media,
    "op5_quality": op5_quality,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_chat": op7_chat,
    "op8_ann": op8_ann,
    "op9_sharding": op9_sharding,
    "op10_licenses": op10_licenses,
    "op11_packing": op11_packing,
    "op12_importance": op12_importance,
    "op13_interval_overlap": op13_interval_overlap,
}

# CRC-32 of a text's UTF-8 bytes, by the table of the reversed polynomial.
_CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(c ORDER BY n) AS tab FROM (SELECT n,
  list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS t(n)))"""
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)),
  lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)"""

_ESCAPED = r"regexp_replace(replace({0}, '\', '\\'), '([<\[])(/?(?:s>|INST\]))', '\1\\\2', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5('0:' || coalesce(doc_id::VARCHAR, '')) AS spot FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM t),
r AS (SELECT *, cap / weight AS fill, (SELECT sum(source_size) FROM t)::DOUBLE * 1.5 AS budget FROM w),
l AS (SELECT *, (budget - coalesce((SELECT sum(cap) FROM r AS b WHERE b.fill < r.fill), 0)::DOUBLE)
                / (SELECT sum(weight) FROM r AS b WHERE b.fill >= r.fill)::DOUBLE AS level FROM r),
f AS (SELECT source, source_size, CASE WHEN fill <= level THEN cap::DOUBLE
        ELSE weight * (SELECT arg_min(level, fill) FROM l AS b WHERE b.fill > b.level) END AS target FROM l),
c AS (SELECT s.*, f.source_size, f.target, sum(size) OVER (PARTITION BY s.source ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM s JOIN f ON s.source IS NOT DISTINCT FROM f.source),
e AS (SELECT c.*, epoch, (upto + source_size * epoch)::DOUBLE / nullif(target, 0) AS finish FROM c, (VALUES (0), (1)) AS x(epoch)),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, spot, doc_id, size, epoch ROWS UNBOUNDED PRECEDING) AS spent FROM e WHERE finish IS NOT NULL),
k AS (SELECT doc_id, count(*) AS copies FROM g WHERE spent <= (SELECT sum(target) FROM f) GROUP BY doc_id)
SELECT c.doc_id, size, source_size, target, (size * coalesce(copies, 0))::BIGINT AS taken, source, coalesce(copies, 0)::INT AS copies
FROM c LEFT JOIN k ON c.doc_id = k.doc_id""",
    "op7_chat": rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS all_n,
        length({_ESCAPED.format('text')}) + length(replace({_ESCAPED.format('role')}, chr(10), '\' || chr(10)))
          + 1 + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END AS chars
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR n = all_n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id""",
    "op12_importance": rf"""
WITH {_CRC_TABLE},
texts AS (SELECT 'raw' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 'target', NULL, NULL, text FROM benchmark),
w AS (SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
n AS (SELECT side, r, word, count(*) AS n FROM w GROUP BY ALL),
v AS (SELECT word, {_CRC.format('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM n), crc_table),
b AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'raw'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE side = 'target'), 0)::BIGINT AS t FROM n JOIN v ON n.word = v.word GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM b),
f AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM n JOIN v ON n.word = v.word JOIN g ON v.bucket = g.bucket WHERE side = 'raw' GROUP BY r),
h AS (SELECT texts.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(texts.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM texts LEFT JOIN f ON texts.r = f.r WHERE side = 'raw'),
k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place FROM h)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM h WHERE n_features >= 20) THEN place END AS rank FROM k""",
    "op13_interval_overlap": rf"""
WITH {_CRC_TABLE},
c AS (SELECT client_id, ts, kind, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS fresh FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY client_id ORDER BY ts)),
m AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY ts) AS session FROM c),
e AS (SELECT client_id, min(ts) AS first, max(ts) AS last, arg_max(kind, (ts, kind IS NOT DISTINCT FROM 'error')) IS NOT DISTINCT FROM 'error' AS is_open FROM m GROUP BY client_id, session),
s AS (SELECT client_id, epoch_us(first) // 21600000000 AS x, CASE WHEN is_open THEN 1000000000000 ELSE epoch_us(last) // 21600000000 END AS y, {_CRC.format("epoch_us(first)::VARCHAR")} AS crc FROM e, crc_table),
l AS (SELECT sale_id, max(shipped_at) AS shipped FROM sale_lines GROUP BY sale_id),
i AS (SELECT sales.sale_id, client_id, epoch_us(sold_at) // 21600000000 AS a, CASE WHEN status IS NOT DISTINCT FROM 'open' THEN 1000000000000 ELSE epoch_us(greatest(sold_at, shipped)) // 21600000000 END AS b
      FROM sales LEFT JOIN l ON sales.sale_id = l.sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL)
SELECT sale_id, CASE WHEN a < x THEN CASE WHEN b < y THEN 'overlaps' WHEN b = y THEN 'finished_by' ELSE 'contains' END
    WHEN a = x THEN CASE WHEN b < y THEN 'starts' WHEN b = y THEN 'equals' ELSE 'started_by' END
    ELSE CASE WHEN b < y THEN 'during' WHEN b = y THEN 'finishes' ELSE 'overlapped_by' END END AS relation,
  count(*) AS n_pairs, CASE WHEN max(b) = 1000000000000 AND min(y) = 1000000000000 THEN NULL ELSE sum(least(b, y) - greatest(a, x) + 1)::BIGINT END AS overlap_slots, sum(crc)::BIGINT AS sessions_crc
FROM i JOIN s ON i.client_id = s.client_id AND x <= b AND y >= a GROUP BY ALL""",
}
