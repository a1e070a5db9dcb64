"""The operators against plain forms on a small table with every odd case in it."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from linkloom.llm import bitmap, byterepeats, copies, exact, minhash, packing, quality, quotient, sharding, wordrepeats
from linkloom.llm.bpe import Encoder, Vocabulary, decode, encode, token_digests
from linkloom.llm.chat import chat_examples
from linkloom.llm.components import components
from linkloom.llm.queries import TOKENIZERS

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept string, n_words int, size int, _k int, _h int, fp int, `bin` int"
)


def _texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 6))) for _ in range(400)]

    def prose(n: int) -> list[str]:
        return rng.choices(words, k=n)

    passage, base = prose(45), prose(120)
    texts: list[str | None] = [None, "", " \n\t ", "one", "ONE", "one two", "\x00 a b \U0001f600 <|endoftext|> x"]
    for i in range(30):  # near copies: a chain of small changes
        base = list(base)
        base[rng.randrange(len(base))] = f"new{i}"
        texts.append(" ".join(base))
    texts += [" ".join(prose(20) + passage + prose(i)) for i in range(12)]
    texts += [texts[8], texts[8], texts[8].upper(), " ".join(passage[:20]), " ".join(passage[:19]), "z" * 300]
    texts += ["ab" * 400, " ".join(["rep"] * 70), " ".join(prose(20_000)), "x " * 30 + "é" * 60]
    return texts


@pytest.fixture(scope="module")
def rows():
    return [(i * 3 - 9, t) for i, t in enumerate(_texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    wide = [(d, t, None, "hot" if d % 2 else f"s{d % 5}", None, "k", 1, 2, 3, 4, 5, 6) for d, t in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, docs):
    """The same with rows repeated, two null ids and a null source."""
    one = docs.filter("doc_id = 15")
    null_id = F.lit(None).cast("long")
    more = one.unionByName(one.withColumn("doc_id", null_id)).unionByName(one.withColumn("source", F.lit(None)))
    alone = one.withColumns({"doc_id": null_id, "text": F.lit("only here, without an id")})
    return docs.unionByName(more).unionByName(alone).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    with open(f"{TOKENIZERS}/byte_bpe_50k.json") as file:
        return file.read()


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_quotient_filter_counts_all_bits():
    values = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
    values = np.r_[values, values[:100], values[:10], np.uint64([0, 0, 2**64 - 1])]
    halves = [b for part in (values[:300], values[300:]) for b in quotient.build(part, 5, 7)]
    want, found = Counter(values.tolist()), Counter()
    for block, filters in pd.DataFrame(halves).groupby("block"):
        (quotients, remainders), counts = quotient.merge(filters)
        for q, r, c in zip(quotients.tolist(), remainders.tolist(), counts.tolist()):
            found[block << 59 | q << 51 | r] = c
    assert found == want


def test_repeated_and_bitmap(spark):
    frame = spark.range(1000).select(F.xxhash64(F.col("id") % 700).alias("fp")).repartition(4)
    got = quotient.repeated(frame, "fp", 1000)
    want = {r.fp: r["count"] for r in frame.groupBy("fp").count().filter("count > 1").collect()}
    assert {r.print: r["count"] for r in got.collect()} == want
    table = bitmap.hash_bitmap(got, "print", 20)
    kept = {r.fp for r in frame.filter(bitmap.may_hold(table, F.col("fp"), spark)).collect()}
    assert want.keys() <= kept and len(kept) < 310


def test_filters_stay_small_with_many_blocks():
    values = np.random.default_rng(2).integers(0, 2**64, 1 << 14, dtype=np.uint64)
    blocks = [*quotient.build(values, 12, 4)]
    assert sum(len(b["runs"]) for b in blocks) == len(blocks) << 8
    assert bitmap.bits_for(0) == bitmap.bits_for(1 << 24) == 27 < bitmap.bits_for(3 << 23) <= bitmap.bits_for(1 << 40)


def test_prints_of_least_hashes_spread():
    """By their first bits, which place them in a bitmap; as they are, nearly all are below 1/8."""
    rng = random.Random(4)
    texts = pa.array(["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(5)])
    table = np.full(1 << 10, 255, np.uint8)
    every = type("Sent", (), {"value": table})
    for find in (byterepeats.trigger_hashes, byterepeats.context_hashes(every)):
        prints = np.concatenate([*find(texts)])
        assert prints.size > 500 and np.bincount((prints >> np.uint64(61)).astype(int), minlength=8).max() < prints.size / 5


def test_rows_apart_by_a_bitmap_in_the_jvm(spark):
    rows = spark.range(3000).select(F.col("id").alias("_k"), F.xxhash64("id").alias("_h"), F.lit("x").alias("_text"))
    keys = rows.filter("_k % 3 = 0").select("_k", "_h")
    maybe, rest, parts = copies.apart(rows, keys)
    found, others = ({r["_k"] for r in x.collect()} for x in (maybe, rest))
    assert found >= set(range(0, 3000, 3)) and len(found) < 1010 and found | others == set(range(3000)) and not found & others
    assert maybe.columns == rest.columns == rows.columns and parts.count() > 500
    assert "Python" not in maybe._jdf.queryExecution().toString()
    none = copies.apart(rows, keys.limit(0))
    assert none[0].count() == 0 and none[1].count() == 3000


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 3)]
    got = {r.u: r.m for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in [*range(1, 41), 200]} | {i: 100 for i in range(101, 130)}


def test_exact(rows, docs, odd, nothing):
    groups: dict = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    want = {d: (max(g), len(g), d == max(g), brute.sha(t.encode())) for t, g in groups.items() for d in g}
    assert by_id(exact.exact_duplicates(docs), "keep_id", "group_size", "kept", "text_sha256") == want
    got = exact.exact_duplicates(odd).collect()
    assert len(got) == odd.count()
    copied = [r for r in got if r.text_sha256 == brute.sha(dict(rows)[15].encode())]
    assert {(r.keep_id, r.group_size) for r in copied} == {(max(r.doc_id or -99 for r in copied), len(copied))}
    assert [r.kept for r in got if r.group_size == 1 and r.doc_id is None] == [True]
    assert exact.exact_duplicates(nothing).count() == 0


def test_near(rows, docs, odd, nothing):
    for width in (2, 5):
        got = by_id(minhash.near_duplicates(docs, width), "n_shingles", "component_id", "kept")
        assert got == {d: (n, c, c == d) for d, (n, c) in brute.near(rows, width).items()}
    assert any(d != c for d, (_, c) in brute.near(rows).items())
    found = minhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    assert minhash.near_duplicates(nothing).count() == 0


def test_near_group_of_many(spark):
    """A large group of near copies that all share most values, with two that link to it by others."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(150)]
    rows += [(500, " ".join(words[:170] + [f"y{i}" for i in range(30)])), (501, " ".join(words[:100]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(minhash.near_duplicates(docs, 2), "n_shingles", "component_id")
    assert got == brute.near(rows)


def _group_with_far_copies() -> list[tuple]:
    """300 copies of a text that stay similar enough to it, and 100 that do not."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for doc in range(400):
        own = list(words)
        for place in rng.sample(range(150), 4 if doc % 4 else 12):
            own[place] = f"x{rng.randrange(1000)}"
        rows.append((doc, " ".join(own)))
    return rows


def test_near_group_with_far_copies(spark, monkeypatch):
    """Copies too far from the rest of their group are not compared with each of its members."""
    rows, compared, plain = _group_with_far_copies(), [], minhash.verified

    def counted(pairs, docs, width):
        compared.append(pairs.count())
        return plain(pairs, docs, width)

    monkeypatch.setattr(minhash, "verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(minhash.near_duplicates(docs, 2), "n_shingles", "component_id") == brute.near(rows)
    assert sum(compared) < 10 * len(rows)


def test_near_by_whole_sets(spark, rows, docs, monkeypatch):
    """Of classes that meet by their whole sets no linked pair is left out, and few others are met."""
    some = [*_group_with_far_copies(), (400, "a b c d"), (401, "a b c d e"), (402, "a b"), (403, "a b a b")]
    sets = {d: set(s.tolist()) for (d, _), s in zip(some, minhash.shingle_sets(pa.array([t for _, t in some]), 2))}
    hot = spark.createDataFrame([(d, d) for d, _ in some], "cls long, comp long")
    table = spark.createDataFrame(some + some[:50], "doc_id long, text string")  # some come twice
    met = [(r.u, r.v) for r in minhash.by_whole_sets(hot, table, 2).collect()]
    linked = {(a, b) for a in sets for b in sets if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(met) == len(set(met)) and linked <= set(met)
    assert not {(u, v) for u, v in met if u % 4 == 0 and v % 4 == 0 and u < 400} - linked
    monkeypatch.setattr(minhash, "SHORT", 1)
    monkeypatch.setattr(minhash, "DRAWS", 0)
    got = by_id(minhash.near_duplicates(docs, 2), "n_shingles", "component_id")
    assert got == brute.near(rows)


def test_whole_sets_meet_by_lot(spark, monkeypatch):
    """Classes that link to a few members of a large component do not meet all of it, and no component is lost."""
    rng, rows = random.Random(5), []
    for doc in range(600):
        own = [f"w{i}" for i in range(150)]
        for place in rng.sample(range(150), 6 if doc < 520 else 7):
            own[place] = "x"
        rows.append((doc, " ".join(own)))
    sets = {d: set(s.tolist()) for (d, _), s in zip(rows, minhash.shingle_sets(pa.array([t for _, t in rows]), 2))}
    near = {(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    hot = [(d, 0 if d < 520 else d) for d in sets]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "LOTS", 16)
    full = minhash.by_whole_sets(spark.createDataFrame(hot, "cls long, comp long"), table, 2)
    drawn = minhash.by_whole_sets(spark.createDataFrame(hot, "cls long, comp long"), table, 2, minhash.DRAWS)
    full, drawn = ({(r.u, r.v) for r in found.collect()} for found in (full, drawn))

    def joined(pairs):
        names = dict(hot)
        for a, b in pairs & near:
            old, new = max(names[a], names[b]), min(names[a], names[b])
            names = {d: new if c == old else c for d, c in names.items()}
        return names

    assert len(set(joined(full).values())) < 80 and joined(drawn) == joined(full) == joined(near)
    assert 2 * len(drawn) < len(full)


def test_repeated_bytes(rows, docs, odd, nothing):
    got = byterepeats.remove_repeated_bytes(docs)
    assert set(docs.columns) <= set(got.columns)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got.collect()}
    assert found == brute.repeated_bytes(rows)
    assert byterepeats.remove_repeated_bytes(odd).count() == odd.count()
    assert byterepeats.remove_repeated_bytes(nothing).count() == 0


def test_repeated_words(spark, rows, docs, odd, nothing):
    got = wordrepeats.remove_repeated_words(docs)
    found = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept.encode())) for r in got.collect()}
    assert found == brute.repeated_words(rows)
    again = wordrepeats.remove_repeated_words(odd).filter("doc_id = 15")
    assert {r.n_removed for r in again.collect()} == {len(dict(rows)[15].split())}  # doc_id null has it first
    assert wordrepeats.remove_repeated_words(nothing).count() == 0
    clean = wordrepeats.drop_repeated_words(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    text = {r.doc_id: r.text for r in clean.collect()}
    assert all(text[d] == t for d, t in rows if not found[d][1])


def test_subtrees_over_many_ranges(monkeypatch, rows, docs):
    monkeypatch.setattr(wordrepeats, "PER_RANGE", 40)
    got = wordrepeats.remove_repeated_words(docs)
    found = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept.encode())) for r in got.collect()}
    assert found == brute.repeated_words(rows)


def test_small_sorts(monkeypatch, rows):
    phrases = [b"a" * 60, b"a" * 50, bytes(range(60)), bytes(range(5, 58)), b"\0" * 55]
    found, sizes = byterepeats.first_documents(phrases, np.array([5, 2, 9, 3, 1]))
    assert sizes.tolist() == [11, 1, 11, 4, 6]
    assert found.tolist() == [2] * 12 + [9] * 5 + [3] * 4 + [9] * 2 + [3] * 4 + [1] * 6


def test_packing_is_best_fit():
    rng = random.Random(3)
    pieces = [(rng.randint(1, 60), rng.choice(["a", "a", "b", "c", None]), rng.randint(0, 40)) for _ in range(600)]
    frame = pd.DataFrame(pieces, columns=["length", "source", "cluster"])
    frame = frame.assign(doc_id=range(600), start=0, uid=range(600))
    got = packing.pack_group(frame, 64)
    order = zip(got["length"], [None if pd.isna(s) else s for s in got["source"]], got["cluster"])
    assert list(zip(got["bin"], got["bin_offset"])) == brute.packed(list(order), 64)


def test_packing(rows, odd, nothing):
    got = packing.best_fit(odd, 256, 40).toPandas()
    whole = got.groupby("doc_id", dropna=False)["length"].sum()
    assert whole.loc[dict(rows) and -9] == 0 and got[got["length"] == 0]["bin"].isna().all()
    assert whole.sum() == odd.agg(F.sum(F.length("text"))).first()[0]
    placed = got[got["length"] > 0].sort_values(["bin_group", "bin", "bin_offset"])
    assert placed["bin_group"].nunique() > 3
    for _, pieces in placed.groupby(["bin_group", "bin"]):
        ends = pieces["bin_offset"] + pieces["length"]
        assert ends.iloc[-1] <= 256 and pieces["bin_offset"].tolist() == [0, *ends.tolist()[:-1]]
        assert pieces["source"].dropna().is_unique and pieces["cluster"].is_unique
    assert packing.best_fit(nothing).count() == 0
    again = packing.best_fit(odd.repartition(7, "kept", "doc_id").sortWithinPartitions(F.desc("doc_id")), 256, 40)
    assert Counter(again.collect()) == Counter(packing.best_fit(odd, 256, 40).collect())


def test_sharding(rows, docs, odd, nothing):
    got = sharding.byte_shards(docs, 5).orderBy("doc_id").collect()
    assert [r.text_crc32 for r in got] == [zlib.crc32((t or "").encode()) for _, t in sorted(rows)]
    total, before, slots = sum(r["size"] for r in got), 0, Counter()
    for r in got:
        assert r.shard == min(4, (2 * before + r["size"]) * 5 // (2 * total))
        assert r.slot == slots[r.shard] and r.law == "bytes" and r.grown_shard is None
        slots[r.shard] += 1
        before += r["size"]
    for r in sharding.byte_shards(odd, 5).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect():
        assert r.m == r.n - 1
    assert sharding.byte_shards(nothing, 5).count() == 0


def test_chat(spark):
    turns = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "b", "c"], 4: ["a", "c"], 5: ["b"], 6: ["a"] * 1100, 7: ["a"] * 1000}
    rows = [(c, i * 2, "user" if i % 2 else None, t, "x") for c, ts in turns.items() for i, t in enumerate(ts)]
    rows += [(None, 1, "r", "n <|im_end|>", "x"), (None, None, "r", None, "x"), (8, 1, "q", "t", "x"), (8, 1, "q", "t", "x")]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string").repartition(4)
    got = chat_examples(convs).collect()
    assert Counter(r.conv_id for r in got) == {2: 1, 4: 1, 5: 1, 6: 3, 8: 1, None: 1}
    text = {r.conv_id: r.text for r in got if r.conv_id != 6}
    assert text[2] == "<|im_start|>\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n<|im_start|>\nc<|im_end|>\n"
    assert text[None] == "<|im_start|>r\n<|im_end|>\n<|im_start|>r\nn < |im_end|><|im_end|>\n"
    assert text[8] == "<|im_start|>q\nt<|im_end|>\n" * 2
    assert [r.n_turns for r in sorted((r for r in got if r.conv_id == 6), key=lambda r: r.piece)] == [512, 512, 76]
    assert chat_examples(convs.limit(0)).count() == 0
    plan = chat_examples(convs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bpe(rows, docs, odd, nothing, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer)
    library.no_padding()
    library.no_truncation()
    want = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(text.encode()))
    assert by_id(token_digests(docs, tokenizer), "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert by_id(decode(encode(docs, tokenizer), tokenizer), "text") == {d: (t or "",) for d, t in rows}
    assert token_digests(odd, tokenizer).count() == odd.count()
    assert token_digests(nothing, tokenizer).count() == 0
    vocabulary = Vocabulary(tokenizer)
    encoder = Encoder(vocabulary)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices("aAbé \n\t'st19.,!　\u0085漢<|endoftext|>", k=rng.randint(0, 40)))
        assert encoder.tokens(text) == library.encode(text, add_special_tokens=False).ids


def test_quality(spark, odd, nothing):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 != 0
        words = rng.choices(["the", "river", "runs", "down", "to", "sea", "under", "stone"], k=rng.randint(30, 80))
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")
    got = quality.quality_scores(docs, marks).toPandas().set_index("doc_id")
    held = pd.Series({i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(400)})
    assert (got["held_out"] == held).all() and held.sum() > 50
    right = (got["predicted"] == pd.Series(dict(labels)))[held]
    assert right.mean() > 0.97 and got["score"].between(0, 1).all()
    # Labels of held-out rows change nothing.
    other = marks.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.quality_scores(docs, other).toPandas().set_index("doc_id")
    assert (again["score"] - got["score"]).abs().max() < 1e-9
    scored = quality.quality_scores(odd, marks)
    assert scored.count() == odd.count() and scored.filter("score is null").count() == 0
    assert quality.quality_scores(nothing, marks).count() == 0
    assert {r.score for r in quality.quality_scores(docs, marks.limit(0)).collect()} == {0.5}
    good = quality.keep_good(docs, marks)
    assert good.columns == docs.columns and good.count() == int(got["predicted"].sum())


def test_pairs_are_scored_by_the_identity():
    rng = np.random.default_rng(0)
    size = (1 << quality.WORD_BITS) + quality.N_STATS
    model = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, 3)), np.zeros(18), np.ones(18))
    found = quality.Hasher().row("a b b c\nd e")
    rows = model.rows([found])
    x = np.zeros(size)
    np.add.at(x, rows.places, rows.values)
    used = rows.places
    pairs = sum(
        float(model.factors[i] @ model.factors[j]) * rows.values[a] * rows.values[b]
        for a, i in enumerate(used)
        for b, j in enumerate(used[:a])
    )
    assert model.margins(rows)[0][0] == pytest.approx(0.3 + float(model.weights @ x) + pairs)


def test_pipeline(spark, tmp_path, docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(*columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, path = frame, f"{tmp_path}/{name}"
        stage(spark, frame, str(tmp_path)).write.parquet(path)
        frame = spark.read.parquet(path)
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        if name == "best-fit packing":
            assert {r.doc_id for r in frame.collect()} == {d for d, _ in rows}
            break
        assert frame.columns == columns
        got = {r.doc_id: r.text for r in frame.collect()}
        if name == "exact dedup":
            assert got.keys() == {max(d for d, t in rows if (t or "") == x) for x in {t or "" for _, t in rows}}
        elif name == "near dedup":
            assert got.keys() == {d for d, (_, c) in brute.near(rows, 5).items() if c == d}
        elif name == "substring dedup":
            want = brute.repeated_words(rows)
            assert {d: len((t or "").split()) for d, t in got.items() if want[d][1]} == {
                d: n - gone for d, (n, gone, _) in want.items() if gone
            }
    assert set(corpus_pipeline.run(spark, str(tmp_path)).columns) == set(frame.columns)


def test_dropped_rows_are_judged_by_their_own_text(spark, odd, nothing):
    words = [f"w{i}" for i in range(100)]
    near, clean = " ".join(words[:99] + ["other"]), "a clean text " + " ".join(reversed(words))
    rows = [(1, " ".join(words)), (2, near), (2, clean), (2, clean), (None, near), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = Counter(map(tuple, minhash.drop_near_duplicates(docs).collect()))
    assert left == Counter(rows) - Counter([(2, near)])
    left = Counter(map(tuple, exact.drop_exact_duplicates(docs).collect()))
    # near stands under doc_id 2 as well as without one; rows written twice stay once
    assert left == Counter([(1, " ".join(words)), (2, near), (2, clean), (9, "")])
    for drop in (exact.drop_exact_duplicates, minhash.drop_near_duplicates, wordrepeats.drop_repeated_words):
        assert drop(nothing).count() == 0 and drop(odd).columns == odd.columns
    once = exact.drop_exact_duplicates(odd)
    assert once.count() == once.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_hot_trigger_is_split(spark, monkeypatch):
    """A passage in many documents with other words around it gives as many phrases under its triggers."""
    line = b"0123456789abcdefghijklmnopqrstuvwxyz+-*/ABC".decode()
    rng = random.Random(3)
    around = lambda: "".join(rng.choices("qwertyuiop ", k=70))
    rows = [(i, around() + line + around()) for i in range(150)]
    rows += [(i, rows[i - 200][1][40:150] + around()) for i in range(200, 230)]
    # Both filters would drop strings of one row only: keep every window of every row.
    rows += [(i + 1000, "x" + t) for i, t in rows[:150]]
    monkeypatch.setattr(byterepeats, "SORTED", 2000)
    most = []

    def watched(dictionary, run=byterepeats.dictionary_order):
        n = dictionary.groupBy("trigger").agg(F.sum(F.octet_length("phrase") - 49).alias("n"))
        most.append(n.agg(F.max("n")).first()[0])
        return run(dictionary)

    monkeypatch.setattr(byterepeats, "dictionary_order", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = byterepeats.remove_repeated_bytes(docs)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in found.collect()}
    assert found == brute.repeated_bytes(rows)
    assert most[0] < 2000
