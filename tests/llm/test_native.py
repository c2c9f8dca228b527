from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from oracle import same
from pyspark.sql import functions as F

from sentrylake.llm import chat, mixing, queries, sharding


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Chat.
TURNS = [(1, 0, "system", "be [INST] kind"), (1, 1, "user", "hi\\ </s>"), (1, 2, "assistant", "yo \\[INST] <s>"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye\n"), (2, 0, "user", "alone"), (3, 1, "assistant", "é🎉"), (3, 1, "assistant", "a"), (None, 0, None, "x"), (4, None, "tool\nbox\\", "t"), (4, 0, "assistant", "\\")]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(turns):
    by = defaultdict(list)
    for c, n, role, text in turns:
        by[c].append((n is not None, n or 0, role or "", text or ""))
    out = {}
    for c, rows in by.items():
        rows.sort()
        spelled = "".join(f"{r}\n{t}\n" for *_, r, t in rows)
        loss = "".join(t for *_, r, t in rows if r == "assistant")
        out[c] = (len(rows), hashlib.sha256(spelled.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_chat_round_trip_with_control_strings_nulls_and_ties(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA).withColumn("example", F.lit("clash")).withColumn("context", F.lit("clash"))
    examples = chat.expand_replies(turns)
    assert digests(chat.read_back(examples)) == expected(TURNS)
    one = examples.where("conv_id = 1").orderBy("example").collect()
    assert [r["reply"] is not None for r in one] == [True, True, False]
    assert one[0]["context"].startswith("[INST]system\n") and "be [\\INST] kind" in one[0]["context"]
    for r in examples.collect():
        whole = r["context"] + r["reply_open"] + (r["reply"] or "") + r["reply_close"]
        n = len([1 for m in ("<s>", "[INST]") for _ in range(whole.count(m))])
        assert n == whole.count("</s>") + whole.count("[/INST]")
    assert one[1]["context"].startswith(one[0]["context"] + one[0]["reply_open"] + one[0]["reply"] + one[0]["reply_close"])


def test_chat_on_long_texts_and_empty_tables(spark):
    long = [(1, 0, "user", "</s>[INST] \\" * 50_000), (1, 1, "assistant", "x" * 300_000)]
    assert digests(chat.read_back(chat.expand_replies(spark.createDataFrame(long, SCHEMA)))) == expected(long)
    assert chat.read_back(chat.expand_replies(spark.createDataFrame([], SCHEMA))).count() == 0


def test_chat_stays_native_and_shuffles_once(spark, sf_dir):
    plan = plan_of(queries.op7_chat(spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


# Sharding.
def law(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("n, shards", [(0, 8), (1, 8), (7, 8), (8, 8), (1000, 7), (3000, 1)])
def test_shards_are_level_and_gapless(spark, n, shards):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"), F.col("id").alias("bucket"))
    out = sharding.shuffle_into_shards(rows, shards, rows_per_bucket=64).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(n)) and all(r["bucket"] == r["doc_id"] for r in out)
    law(out, shards) if n else None


def test_shards_with_nulls_repeats_and_reruns(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None), (2, None)] * 3, "doc_id long, text string")
    first, second = (sorted(map(tuple, sharding.shuffle_into_shards(r, 4, seed=3).collect()), key=repr) for r in (rows, rows.repartition(7)))
    assert first == second and len(first) == 18
    other = sorted(map(tuple, sharding.shuffle_into_shards(rows, 4, seed=4).collect()), key=repr)
    assert first != other


def test_many_copies_of_a_row_spread_over_the_buckets(spark):
    """Rows that are equal in all columns, and rows that share an id, cost what others cost, and agree on reruns."""
    rows = spark.range(6000).select(F.lit(5).cast("long").alias("doc_id"), F.when(F.col("id") < 3000, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit(1).alias("times"))
    first, second = (sorted(map(tuple, sharding.shuffle_into_shards(r, 8, rows_per_bucket=64).collect())) for r in (rows, rows.repartition(7)))
    assert first == second and len(first) == 6000
    places = sorted((shard, slot) for _, text, _, shard, slot in first if text == "same")
    share = [sum(s == k for s, _ in places) for k in range(8)]
    assert min(share) > 200 and max(share) < 550


def test_fisher_yates_is_a_uniform_permutation(spark):
    rows = spark.range(6000).select(sharding.fisher_yates(F.lit(4), F.lit(1), F.col("id")).alias("p")).collect()
    seen = Counter(tuple(r["p"]) for r in rows)
    assert len(seen) == 24 and max(seen.values()) < 2 * min(seen.values())
    big = spark.range(3).select(sharding.fisher_yates(F.lit(500), F.col("id")).alias("p")).collect()
    assert all(sorted(r["p"]) == list(range(500)) for r in big)
    assert spark.range(1).select(sharding.fisher_yates(F.lit(0), F.lit(1))).first()[0] == []


def test_permutations_are_those_of_a_plain_fisher_yates(spark):
    """Drawn with the same hashes, a plain inside-out shuffle gives the same order."""
    n = 40
    draws = [r[0] for r in spark.range(n).select(F.pmod(F.xxhash64(F.lit(9), F.col("id").cast("int")), F.col("id") + 1)).orderBy("id").collect()]
    plain = []
    for i, j in enumerate(draws):
        plain.append(i)
        plain[i], plain[j] = plain[j], i
    assert spark.range(1).select(sharding.fisher_yates(F.lit(n), F.lit(9))).first()[0] == plain


def test_sharding_query(spark, sf_dir):
    df = queries.op9_sharding(spark, sf_dir)
    assert "Python" not in plan_of(df)
    rows, docs = df.collect(), {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    law(rows, 8)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {k: (len(t) + 1, zlib.crc32(t)) for k, t in docs.items()}


def test_sharding_query_reads_whole_documents_from_written_shards(spark, sf_dir):
    df = queries.op9_sharding(spark, sf_dir)
    files = df.inputFiles()
    folders = {f.rsplit("/", 2)[1] for f in files}
    assert folders == {f"shard={k}" for k in range(8)}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stored = spark.read.parquet(files[0].rsplit("/", 2)[0])
    assert sorted(map(tuple, stored.select(docs.columns).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    for f in files:
        slots = [r["slot"] for r in spark.read.parquet(f).select("slot").collect()]
        assert slots == list(range(slots[0], slots[0] + len(slots)))
    place = ["doc_id", "shard", "slot"]
    wanted = sharding.shuffle_into_shards(docs, 8).select(place).collect()
    assert sorted(map(tuple, df.select(place).collect())) == sorted(map(tuple, stored.select(place).collect())) == sorted(map(tuple, wanted))


def test_stored_shards_of_no_documents(spark):
    assert sharding.stored_shards(spark.createDataFrame([], "doc_id long, text string"), 8).collect() == []


def test_written_shards_are_in_slot_order(spark, tmp_path):
    out = sharding.shuffle_into_shards(spark.range(500).withColumnRenamed("id", "doc_id"), 3)
    sharding.write_shards(out, str(tmp_path / "s"))
    import pyarrow.parquet as pq

    for s in range(3):
        files = sorted((tmp_path / "s" / f"shard={s}").glob("*.parquet"))
        slots = [x for f in files for x in pq.read_table(f, partitioning=None)["slot"].to_pylist()]
        assert slots == list(range(len(slots)))


# Mixing.
def plain_mix(rows, weights=(3, 1, 2), share=1.5, repeat=2):
    """(targets, copies) by one global sort."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n or 0
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    budget, target, free = share * sum(sizes.values()), {}, set(sizes)
    while free:
        rest = budget - sum(target.values())
        level = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if level[s] >= repeat * sizes[s]}
        target |= {s: repeat * sizes[s] for s in over} if over else level
        free -= over if over else free
    queue, upto = [], defaultdict(int)
    at = lambda d: hashlib.md5(f"0:{'' if d is None else d}".encode()).hexdigest()
    for d, s, n in sorted(rows, key=lambda r: (at(r[0]), r[0] is not None, r[0] or 0, r[2] or 0)):
        upto[s] += n or 0
        for e in range(repeat):
            if target[s]:
                queue.append(((upto[s] + sizes[s] * e) / target[s], at(d), d is not None, d or 0, n or 0, e, s))
    spent, copies = 0, Counter()
    for _, _, known, d, n, _, s in sorted(queue):
        if spent + n > budget * (1 + 1e-12):
            break
        spent += n
        copies[(d if known else None, s, n)] += 1
    return target, copies


def check_mix(spark, rows, pieces=None, monkeypatch=None):
    df = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("target", F.lit("clash")))
    got = df.collect()
    target, copies = plain_mix(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["copies"] in (0, 1, 2)
    found = Counter()
    for r in got:
        found[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    assert +found == +copies
    return got


def test_mix_equals_one_global_sort(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_PIECE", 8)
    rows = [(i, f"s{i * i % 7 if i % 3 else 0}", (i * 7919) % 97) for i in range(600)]
    got = check_mix(spark, rows)
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
    for s, t in {r["source"]: r["target"] for r in got}.items():
        assert abs(taken[s] - t) <= 97


def test_mix_edges(spark):
    check_mix(spark, [(1, None, 5), (2, "a", None), (None, "a", 3), (None, "a", 4), (5, "b", 0)])
    check_mix(spark, [(1, "a", 1)])
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0
    same_size = check_mix(spark, [(i, "a", 10) for i in range(20)] + [(100 + i, "b", 10) for i in range(20)] + [(200 + i, "c", 10) for i in range(20)])
    assert sum(r["copies"] for r in same_size) == 90


def test_mixed_rows_keep_their_columns_and_repeats(spark):
    docs = spark.createDataFrame([(1, "x y", "a", "k"), (1, "x y", "a", "k"), (2, "z", "b", "m"), (None, None, None, None)], "doc_id long, text string, source string, nth string")
    size = mixing.word_count(F.col("text"))
    decided = mixing.mix_sources(docs.select("doc_id", "source", size.alias("size")))
    out = mixing.take_mix(docs, decided, size)
    assert out.columns == docs.columns
    wanted = sum(r["copies"] for r in decided.collect())
    assert out.count() == wanted


def test_rows_of_one_place_are_taken_as_often_as_decided(spark):
    """Many rows with one id and size, of which the budget covers some only: as many come out, from all tasks together."""
    rows = [(7, f"w{i} x", "a") for i in range(50)] + [(i, "y z", "b") for i in range(100, 140)] + [(None, "p q r", None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    size = mixing.word_count(F.col("text"))
    decided = mixing.mix_sources(docs.select("doc_id", "source", size.alias("size")))
    wanted = Counter()
    for r in decided.collect():
        wanted[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in mixing.take_mix(docs, decided, size).collect())
    assert got == +wanted and 50 < got[(7, "a", 2)] < 100


def test_word_count(spark):
    for text, n in ((None, 0), ("", 0), (" \t\n\x0b\x0c\r", 0), ("a b c", 2), ("x" * 100_000, 1)):
        assert spark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0] == n
