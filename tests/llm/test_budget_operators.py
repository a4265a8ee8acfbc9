"""Mixing, sharding, packing and language identification."""

import random
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.llm import brute
from valora.llm.langid import learn, with_language
from valora.llm.mixing import budgets, mix
from valora.llm.packing import best_fit, pack, unpack
from valora.llm.sharding import min_cost_flow, near_equal, reshard, rewrite


def fill(caps, weights, budget):
    """Shares by weight, none above its cap, by repeated rounds."""
    given, open_ = dict.fromkeys(caps, 0.0), {k for k in caps if weights[k] > 0}
    while open_ and budget > 1e-9:
        unit = budget / sum(weights[k] for k in open_)
        full = {k for k in open_ if caps[k] - given[k] <= unit * weights[k]}
        if not full:
            for k in open_:
                given[k] += unit * weights[k]
            break
        for k in full:
            budget -= caps[k] - given[k]
            given[k] = caps[k]
        open_ -= full
    return given


@pytest.mark.parametrize("share", [0.1, 0.6, 3.0])
def test_budgets(spark, share):
    r = random.Random(2)
    leaves = {(f"d{a}", f"l{b}", f"s{c}"): r.choice([0, 5, 100, 3000]) for a in range(3) for b in range(2) for c in range(3)}
    weights = {("d0",): 3.0, ("d1", "l0"): 0.0, ("d2", "l1", "s2"): 5.0}
    weight = lambda path: weights.get(path, 1.0)
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "l_domain string, l_lang string, l_source string, tokens long")
    got = {(r[0], r[1], r[2]): r.given for r in budgets(df, weights, F.sum("tokens") * share, 2).select(
        "l_domain", "l_lang", "l_source", "given").collect()}
    cap = lambda path: 2.0 * sum(v for k, v in leaves.items() if k[:len(path)] == path)
    state = {(): sum(leaves.values()) * share}
    for depth in (1, 2, 3):
        new = {}
        for parent, budget in state.items():
            kids = sorted({k[:depth] for k in leaves if k[:depth - 1] == parent})
            new |= fill({k: cap(k) for k in kids}, {k: weight(k) for k in kids}, budget)
        state = new
    assert all(abs(got[k] - state[k]) <= 1 for k in leaves)


def test_mix_takes_whole_passes_and_a_prefix(spark):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randint(0, 9)), r.choice(["en", None]), r.choice(["a", "b", "c", None]), "x") for i in range(200)]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, lang string, source string, h string")
    out = mix(df, share=0.7, max_epochs=3, seed=5)
    assert out.columns == [*df.columns, "epoch"]
    got, again = sorted(map(str, out.collect())), sorted(map(str, mix(df.repartition(7), share=0.7, max_epochs=3, seed=5).collect()))
    assert got == again
    total = sum(len(brute.words(t)) for _, t, *_ in [*rows, rows[0]])
    taken = out.agg(F.sum(F.regexp_count("text", F.lit("w")))).first()[0]
    assert 0.7 * total - 9 * 8 <= taken <= 0.7 * total
    full = out.groupBy("lang", "source").agg(F.max("epoch").alias("m")).filter("m > 2").count()
    assert full == 0
    assert mix(df, share=5.0, max_epochs=1).count() == 201
    assert mix(df.limit(0)).count() == 0


def test_flow_moves_the_least():
    r = random.Random(6)
    for _ in range(30):
        m, k = r.randint(1, 5), r.randint(1, 6)
        supply = [r.randint(0, 40) for _ in range(m)]
        capacity = near_equal(sum(supply), k)
        flow = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
        assert [sum(line) for line in flow] == supply
        assert all(sum(line[j] for line in flow) <= capacity[j] for j in range(k))
        stay = sum(flow[j][j] for j in range(min(m, k)))
        assert stay == sum(min(supply[j], capacity[j]) for j in range(min(m, k)))
    assert min_cost_flow([5, 0], [5, 5], lambda i, j: [[9, 1], [0, 0]][i][j]) == [[0, 5], [0, 0]]
    with pytest.raises(ValueError):
        min_cost_flow([5], [4], lambda i, j: 0)


def test_reshard(spark, tmp):
    r = random.Random(7)
    rows = [(i, None if i % 50 == 0 else "é" * r.randint(0, 400), r.choice([0, 0, 0, 1, None, 4]), 9) for i in range(600)]
    rows += [rows[3]] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, old int, slot int")
    out = reshard(df, F.col("old"), 6)
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["doc_id", "text", "old", "size", "old_shard", "shard", "slot"] or set(
        out.columns) == {"doc_id", "text", "old", "size", "old_shard", "shard", "slot"}
    sizes, slots = {}, {}
    for x in got:
        assert x["size"] == len((x.text or "").encode()) + 8
        sizes[x.shard] = sizes.get(x.shard, 0) + x["size"]
        slots.setdefault(x.shard, []).append(x.slot)
    assert set(sizes) == set(range(6)) and max(sizes.values()) - min(sizes.values()) <= 2 * 808
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    moves = rewrite(out, f"{tmp}/shards").collect()
    assert sum(m["rows"] for m in moves) == len(rows)
    assert spark.read.parquet(f"{tmp}/shards").count() == len(rows)
    assert reshard(df.limit(0), F.col("old"), 6).count() == 0


def test_rewrite_in_place(spark, tmp):
    """An existing layout: shard 0 is untouched, 3 is emptied, 1 and 2 grow."""
    rows = [(i, f"{i} " + "é" * (i % 90), i % 4) for i in range(400)] + [(7, None, 3)]
    path = f"{tmp}/shards"
    spark.createDataFrame(rows, "doc_id long, text string, shard int").write.partitionBy("shard").parquet(path)
    sizes = [sum(len((t or "").encode()) + 8 for _, t, k in rows if k == shard) for shard in range(4)]
    capacities = [sizes[0], sizes[1] + sizes[3] // 2, sizes[2] + sizes[3] - sizes[3] // 2]
    before = {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(path, "shard=0").iterdir()}
    old = spark.read.parquet(path).withColumnRenamed("shard", "old")
    moves = {(m.old_shard, m.shard): m.rows for m in rewrite(reshard(old, F.col("old"), 3, capacities), path).collect()}
    assert set(moves) == {(0, 0), (1, 1), (2, 2), (3, 1), (3, 2)} and sum(moves.values()) == len(rows)
    assert {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(path, "shard=0").iterdir()} == before
    assert sorted(p.name for p in Path(path).glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    got = spark.read.option("mergeSchema", True).parquet(path).select("doc_id", "text").collect()
    assert sorted(map(str, got)) == sorted(str(Row(doc_id=i, text=t)) for i, t, _ in rows)


@pytest.mark.parametrize("null", [False, True])
def test_reshard_files(spark, tmp, null):
    from valora.llm.sharding import reshard_files
    rows = [(i, f"{i} " + "é" * (i % 90), None if null and not i % 8 else i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    df.write.partitionBy("shard").parquet(f"{tmp}/shards")
    sizes = [sum(len(t.encode()) + 8 for _, t, k in rows if (k or 0) == shard) for shard in range(4)]
    capacities = [sizes[0], sizes[1] + sizes[3] // 2, sizes[2] + sizes[3] - sizes[3] // 2]
    got = reshard_files(spark, f"{tmp}/shards", df.schema, 3, capacities).collect()
    assert sorted((x.doc_id, x.text, x.old_shard) for x in got) == [(i, t, k or 0) for i, t, k in rows]
    assert {(x.old_shard, x.shard) for x in got} == {(0, 0), (1, 1), (2, 2), (3, 1), (3, 2)}
    for shard in range(3):
        slots = sorted(x.slot for x in got if x.shard == shard)
        assert slots == list(range(len(slots)))
    assert sorted(p.name for p in Path(tmp, "shards").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    none = df.limit(0)
    none.write.partitionBy("shard").parquet(f"{tmp}/none")
    assert reshard_files(spark, f"{tmp}/none", none.schema, 3).count() == 0


def test_sharding_query_rows_come_from_files(spark):
    from valora.llm.queries import op7_sharding
    out = op7_sharding(spark, "/root/testdata/sf0.001")
    files = {f.split("/shard=")[0] for f in out.inputFiles()}
    assert len(files) == 1 and "/shards-" in files.pop()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    true = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c")).collect()
    assert sorted((x.doc_id, x.text_crc32) for x in out.collect()) == sorted(map(tuple, true))


def test_best_fit():
    r = random.Random(8)
    for limit in (1, 7, 64, 100):
        sizes = [r.randint(1, limit) for _ in range(300)]
        rows, left, plain = best_fit(sizes, limit), [], []
        for k in sorted(range(300), key=lambda k: (-sizes[k], k)):
            fits = [j for j in range(len(left)) if left[j] >= sizes[k]]
            if fits:
                j = min(fits, key=lambda j: left[j])
                left[j] -= sizes[k]
            else:
                left.append(limit - sizes[k])
        assert sorted(k for row in rows for k in row) == list(range(300))
        assert all(sum(sizes[k] for k in row) <= limit for row in rows)
        assert sorted(limit - sum(sizes[k] for k in row) for row in rows) == sorted(left)
        del plain


def test_pack_is_lossless(spark, docs):
    rows = [(1, None), (2, ""), (3, "a short text"), (4, "long " * 3000), (5, "é漢🙂 <|endoftext|>\n\n"), (6, " "), (7, "x" * 900),
            (8, " " * 2_000_000), (9, "\n\t" * 600_000)]
    packed = pack(docs(rows), row_tokens=128, group_tokens=1000)
    for x in packed.collect():
        assert len(x.ids) == 256 and x.cu_seqlens[0] == 0 and x.cu_seqlens[-1] == x.n_tokens <= 128
        assert x.position_resets == x.cu_seqlens[:-1] and len(x.doc_ids) == len(x.pieces) == len(x.position_resets)
    assert dict(map(tuple, unpack(packed).collect())) == {i: t or "" for i, t in rows}
    assert pack(docs([])).count() == 0


def test_languages(spark):
    r = random.Random(9)
    say = {"aa": ["kama", "tolu", "wani", "sora"], "bb": ["grubsch", "stelz", "pfinck", "dorft"]}
    text = lambda lang, n: " ".join(r.choice(say[lang]) for _ in range(n))
    taught = spark.createDataFrame([(text(x, 30), x) for x in say for _ in range(20)] + [("noise", None)], "text string, lang string")
    model = learn(taught)
    assert model[0] == ["aa", "bb"]
    rows = [(1, text("aa", 50)), (2, text("bb", 3)), (3, text("aa", 30) + " " + text("bb", 10)), (4, None), (5, ""), (6, "12 !? 3"),
            (7, "漢字"), (8, "×÷ ")]
    df = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, lang string")
    got = {x.doc_id: x.language for x in with_language(df, model).collect()}
    assert got[1].lang_pred == "aa" and got[1].score > 0.99 and [m.lang for m in got[1].mixture] == ["aa"]
    assert got[2].lang_pred == "bb"
    assert got[3].lang_pred == "aa" and abs(got[3].score - 0.75) < 0.05 and len(got[3].mixture) == 2
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (4, 5, 6, 8)) and got[7].lang_pred in ("aa", "bb")
    nothing = learn(taught.limit(0))
    assert {x.language.lang_pred for x in with_language(df, nothing).collect()} == {"und"}


def test_languages_held_out(spark):
    from valora.llm.queries import op9_language_id
    found = op9_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    true = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(true, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
