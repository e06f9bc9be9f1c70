import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chunks, cooccur, packing, topics

from .helpers import alike, rows

BASKETS = [("1", ["#Nifty", "nifty ", "ＳＥＮＳＥＸ"], "sensex"), ("1", ["gold"], "nifty"), ("2", None, "sensex"), ("3", ["", "#", None, "gold"], "nifty"), ("4", [], ""), (None, ["gold"], "nifty"), ("5", [f"t{i}" for i in range(90)], "nifty"), ("3", ["gold"], "nifty")]


def _baskets(spark, data):
    return cooccur.baskets(spark.createDataFrame([(*d, 1, "c") for d in data], "id string, hashtags array<string>, source string, tag int, tags string"), "id", F.col("hashtags"), F.array("source"))


def _brute(data):
    sets = {}
    for i, tags, source in data:
        if i is not None:
            clean = {t.translate({c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}).lower().strip().lstrip("#").strip() for t in [*(tags or []), source] if t}
            sets.setdefault(i, set()).update(clean - {""})
    n = {}
    for s in sets.values():
        for a, b in itertools.combinations(sorted(s), 2):
            n[a, b] = n.get((a, b), 0) + 1
    one = {}
    for s in sets.values():
        for t in s:
            one[t] = one.get(t, 0) + 1
    return sorted((a, b, k, one[a], one[b], len(sets)) for (a, b), k in n.items())


def _scores(state):
    return sorted(tuple(r)[:6] for r in state.scores().collect())


def test_pairs_equal_brute_force_with_large_baskets(spark):
    assert _scores(cooccur.PairTable(spark).apply(_baskets(spark, BASKETS))) == _brute(BASKETS)


def test_signed_deltas_equal_a_new_count(spark):
    rng, tags = random.Random(1), [f"t{i}" for i in range(12)]
    data = [(str(i), rng.sample(tags, rng.randint(0, 5)), rng.choice(tags)) for i in range(80)]
    changed = [(str(i), rng.sample(tags, rng.randint(0, 5)), rng.choice(tags)) for i in range(60, 110)]
    state = cooccur.PairTable(spark).apply(_baskets(spark, data)).apply(_baskets(spark, changed))
    assert _scores(state) == _brute([d for d in data if int(d[0]) < 60] + changed)
    gone = spark.createDataFrame([(str(i), None) for i in range(50)], "id string, tags array<string>")
    assert _scores(state.apply(gone)) == _brute([d for d in data if 50 <= int(d[0]) < 60] + changed)
    lift = state.scores().withColumn("want", F.col("n") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b"))).where("abs(lift - want) > 1e-9")
    assert lift.count() == 0


def test_a_delta_rewrites_the_buckets_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cooccur, "ROWS", 4)
    monkeypatch.setattr(cooccur, "LEAST_BUCKETS", 1)
    data = [(str(i), [f"a{i % 12}", f"b{i % 12}"], f"c{i % 12}") for i in range(60)]
    one = cooccur.PairTable(spark, f"{tmp_path}/t").apply(_baskets(spark, data))
    assert one.manifest["buckets"] == 15
    changed = [("99", ["a0", "b0"], "b0")]
    two = cooccur.PairTable.latest(spark, f"{tmp_path}/t").apply(_baskets(spark, changed))
    assert _scores(two) == _brute(data + changed)
    assert [list(two.manifest[t].values()).count(2) for t in ("baskets", "counts")] == [1, 1] and 1 <= list(two.manifest["scores"].values()).count(2) <= 3
    # A step that failed leaves files and no manifest: the table is what it was.
    spark.range(1).write.parquet(f"{tmp_path}/t/counts/version=3/bucket=0")
    again = cooccur.PairTable.latest(spark, f"{tmp_path}/t")
    assert again.version == 2 and _scores(again.apply(_baskets(spark, []))) == _brute(data + changed)


def test_associated_and_empty(spark):
    data = [(str(i), ["a", "b"] if i < 10 else ["c"], "x") for i in range(100)]
    assert rows(cooccur.PairTable(spark).apply(_baskets(spark, data)).associated().select("tag_a", "tag_b")) == [("a", "b")]
    assert cooccur.PairTable(spark).apply(_baskets(spark, data).limit(0)).associated().count() == 0


SCHEMA = "rec long, id string, tag string, text string, key int, seq string"


def _texts(rng, n):
    vocabulary = [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(3000)]
    out = []
    for k in range(n):
        if out and rng.random() < 0.4:
            w = rng.choice(out).split()
            w = [x for x in w if rng.random() > 0.05] + rng.sample(vocabulary, rng.randint(0, 2))
            cutting = rng.randint(0, len(w))
            out.append(" ".join(w[cutting:] + w[:cutting]))
        else:
            out.append(" ".join(rng.sample(vocabulary, rng.randint(14, 40))))
    return out


def _history(rng, n, start):
    texts = _texts(rng, n)
    return [(start + i, str(rng.randint(0, n)), rng.choice("xy"), t, 1, "c") for i, t in enumerate(texts)]


def _brute_repeats(old, new):
    out, seen = [], list(old)
    for r in new:
        if r[1] is not None and r[3] is not None:
            if r[2] is not None and any(s[1] == r[1] and s[2] == r[2] for s in seen):
                out.append((r[0], "id"))
            elif any(s[1] not in (None, r[1]) and s[3] is not None and alike(s[3], r[3]) for s in seen):
                out.append((r[0], "text"))
            seen.append(r)
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 3])
def test_repeats_equal_brute_force(spark, parts):
    rng = random.Random(8)
    every = _history(rng, 150, 0)
    old, new = every[:90], every[90:]
    new += [(200, "new1", "x", old[0][3].upper(), 1, "c"), (201, "new2", None, old[0][3], 1, "c"), (202, None, "x", old[0][3], 1, "c"), (203, "new3", "x", None, 1, "c"), (204, "new4", "x", "", 1, "c"), (205, "new5", "x", "", 1, "c"), (206, old[0][1], old[0][2], "w " * 30_000, 1, "c")]
    table = chunks.ChunkTable.begin(spark.createDataFrame(old, SCHEMA), "id", "tag", "text", "rec")
    size = -(-len(new) // parts)
    got = [r for i in range(0, len(new), size) for r in rows(table.check(spark.createDataFrame(new[i : i + size], SCHEMA), "id", "tag", "text", "rec"))]
    want = _brute_repeats(old, new)
    assert len(want) > 15 and sorted(got) == want


def test_repeats_with_few_chunks_in_common(spark):
    """Words swapped, edited one by one or set between long ones: most words are shared, and less than half of the bytes in chunks."""
    rng = random.Random(5)
    old, new = [], []
    for i, t in enumerate(_texts(rng, 40)):
        w = t.split()
        old.append((i, f"old{i}", "x", t, 1, "c"))
        mixed = rng.sample(w, len(w))
        edited = [x if k % 7 else f"edit{k}" for k, x in enumerate(w)]
        longer = [y for k, x in enumerate(w) for y in ([x] if k % 8 else [x, f"{k}" * 60])]
        new += [(1000 + 3 * i + k, f"new{i}{k}", "x", " ".join(x), 1, "c") for k, x in enumerate((mixed, edited, longer))]
    table = chunks.ChunkTable.begin(spark.createDataFrame(old, SCHEMA), "id", "tag", "text", "rec")
    want = _brute_repeats(old, new)
    assert rows(table.check(spark.createDataFrame(new, SCHEMA), "id", "tag", "text", "rec")) == want and len(want) > 100
    with pytest.raises(ValueError):
        table.check(spark.createDataFrame(new, SCHEMA), "id", "tag", "text", "rec", 6, 10)


def test_table_is_opened_again_in_a_new_session(spark, tmp_path):
    """Another session, with other settings and an empty catalog, goes on where the first one stopped; a batch that failed half-way leaves nothing."""
    rng = random.Random(12)
    every = _history(rng, 120, 0)
    path = f"{tmp_path}/kept"
    chunks.ChunkTable.begin(spark.createDataFrame(every[:60], SCHEMA), "id", "tag", "text", "rec", path=path, buckets=5)
    for name in chunks.BUCKETED:
        spark.sql(f"DROP TABLE {chunks.ChunkTable.open(spark, path).name}_{name}")
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "3")
    got, old = [], every[:60]
    for a, b in ((60, 90), (90, 120)):
        again = chunks.ChunkTable.open(other, path)
        assert again.buckets == 5 and again.coverage == chunks.COVERAGE
        lost = again._attempt()
        again._write(chunks._rows(other.createDataFrame([(900, "zz", "x", every[b - 1][3], 1, "c")], SCHEMA), "id", "tag", "text", "rec").drop("text"), "records", lost)
        got += rows(again.check(other.createDataFrame(every[a:b], SCHEMA), "id", "tag", "text", "rec"))
    assert sorted(got) == _brute_repeats(old, every[60:])


def test_repeats_with_empty_history(spark):
    table = chunks.ChunkTable.begin(spark.createDataFrame([], SCHEMA), "id", "tag", "text", "rec")
    batch = spark.createDataFrame([(1, "a", "x", "one two three four five six"), (2, "b", "x", "one two three four five six")], "rec long, id string, tag string, text string")
    assert rows(table.check(batch, "id", "tag", "text", "rec")) == [(2, "text")]
    assert table.check(batch.limit(0), "id", "tag", "text", "rec").count() == 0


def test_chunks_cover_the_text_and_move_with_it():
    import pyarrow as pa

    rng = random.Random(2)
    texts = _texts(rng, 30)
    row, chunk, size = chunks.cut_chunks(pa.array(texts))
    for i, t in enumerate(texts):
        assert size[row == i].sum() + (row == i).sum() - 1 == len(t)
    _, moved, _ = chunks.cut_chunks(pa.array(["zz9 " + texts[0]]))
    assert len(set(moved) & set(chunk[row == 0])) >= (row == 0).sum() - 2
    assert Fraction(1, 3) < Fraction(len(row), sum(len(t.split()) for t in texts)) <= 1
    assert all(len(x) == 0 for x in chunks.cut_chunks(pa.array(["", ""]))) and all(len(x) == 0 for x in chunks.cut_chunks(pa.array([], pa.string())))


def test_chunks_depend_on_their_text_alone():
    import pyarrow as pa

    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdef", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 6))) for _ in range(300)] + [""]
    alone = [chunks.cut_chunks(pa.array([t]))[1].tolist() for t in texts]
    for _ in range(3):
        by = rng.sample(range(len(texts)), len(texts))
        row, chunk, _ = chunks.cut_chunks(pa.array([texts[i] for i in by]))
        assert all(chunk[row == k].tolist() == alone[i] for k, i in enumerate(by))


def test_packing_holds_every_piece(spark):
    rng = np.random.default_rng(0)
    sizes = [(i, int(n)) for i, n in enumerate(rng.lognormal(4, 1, 3000))] + [(5000 + i, 0) for i in range(5)] + [(6000, 512), (6001, 5000), (6002, 256)]
    df = spark.createDataFrame([(*s, 1) for s in sizes], "id long, n_tokens long, rank int")
    out = packing.pack(df, [(1, 256), (2, 512)]).toPandas()
    for p, capacity in ((1, 256), (2, 512)):
        x = out[out.pack_id == p]
        assert (x.groupby("container").n_tokens.sum() <= capacity).all()
        assert x.groupby("id").n_tokens.sum().to_dict() == dict(sizes)
        whole = x.groupby("id").size()
        assert all(whole[i] == max(1, -(-n // capacity)) for i, n in sizes)
        assert not x.duplicated(["id", "piece"]).any()
        assert x.n_tokens.sum() / (x.container.nunique() * capacity) > 0.97
    alone = packing.pack(df, [(1, 256)], fill=False).toPandas()
    assert (alone.groupby("container").n_tokens.sum() <= 256).all() and alone.groupby("id").n_tokens.sum().to_dict() == dict(sizes)
    assert packing.pack(df.limit(0), [(1, 256)]).count() == 0 and packing.pack(df, []).count() == 0


def test_buckets_are_optimal():
    sizes, counts = np.array([1, 2, 5, 6, 9]), np.array([3, 1, 4, 1, 5])

    def padding(ends):
        return sum(c * (min(e for e in ends if e >= s) - s) for s, c in zip(sizes, counts))

    for k in (1, 2, 3, 4):
        best = min(padding(e + (9,)) for e in itertools.combinations(sizes[:-1], k - 1))
        assert padding(packing.choose_buckets(sizes, counts, k)) == best


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|>")], "id long, text string")
    got = {r["id"]: r["n_tokens"] for r in packing.token_counts(df, "id", "text").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1


TERMS = {"law": "court judge appeal verdict plea counsel".split(), "sport": "match goal team coach league referee".split(), "science": "lab sample protein enzyme telescope cohort".split()}
GREETING = ["Thanks for reading this far.", "More on this tomorrow."]


def _documents(n, seed=0):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        subjects = rng.sample(list(TERMS), rng.choice([1, 1, 2]))
        lines = [" ".join(["The", *rng.sample(TERMS[s], 4), "and"]) + "." for s in subjects for _ in range(rng.randint(2, 5))] + [rng.choice(GREETING)]
        rng.shuffle(lines)
        docs.append((i, " ".join(lines), "en", "c"))
        if i % 4 == 0:
            labels += [(i, s) for s in subjects]
        docs[-1] = (*docs[-1], subjects)
    return docs, labels


def test_topics(spark):
    docs, labels = _documents(400)
    extra = [(9000, None, None, "c"), (9001, "", "en", "c"), (9002, GREETING[0], "en", "c"), (None, "court judge", "en", "c"), (9003, "court judge appeal. " * 5000, "en", "c")]
    df = spark.createDataFrame([d[:4] for d in docs] + extra, "doc_id long, text string, lang string, subject string")
    lab = spark.createDataFrame(labels + labels[:5] + [(None, "law"), (1, None)], "doc_id long, subject string")
    model, numbered = topics.fit(df, lab)
    got = {}
    for r in topics.assign(model, numbered).collect():
        got.setdefault(r["id"], set()).add(r["subject"])
    right = sum(got.get(d[0]) == set(d[4]) for d in docs)
    assert right >= 0.97 * len(docs) and got[9003] == {"law"} and not {9000, 9001, 9002} & set(got)
    assert {"law", "sport", "science"} <= set(model.report()["subject"])


def test_every_repeated_sentence_starts_a_topic(spark):
    docs, labels = _documents(300)
    kinds = [f"Good {a} {b} to all." for a in ("morning", "evening", "day", "week", "luck", "cheer", "trade", "rest") for b in ("friends", "readers", "traders", "desks", "members", "guests", "holders", "writers")]
    df = spark.createDataFrame([(d[0], f"{d[1]} {kinds[d[0] % len(kinds)]}", "en") for d in docs], "doc_id long, text string, lang string")
    model, _ = topics.fit(df, spark.createDataFrame(labels, "doc_id long, subject string"), passes=1)
    assert model.logphi.shape[1] >= len(kinds) + len(GREETING) + topics.FREE_TOPICS


def test_distinct_sentences_give_the_same_inference():
    rng = np.random.default_rng(3)
    kinds = [rng.integers(0, 50, rng.integers(1, 9)) for _ in range(12)] + [np.array([3, 4]), np.array([4, 3]), np.array([3])]
    picks = [kinds[i] for i in rng.integers(0, len(kinds), 90)]
    words, sentence = np.concatenate(picks), np.repeat(np.arange(90), [len(p) for p in picks])
    document = np.sort(rng.integers(0, 20, 90))
    logphi = np.log(rng.dirichlet(np.ones(50), 6).T).astype(np.float32)
    part = topics.distinct(words, sentence, document)
    assert len(set(part.owner)) == len({tuple(p) for p in picks})
    assert all((part.words[part.owner == part.which[i]] == p).all() for i, p in enumerate(picks))
    every = topics.Batch(words, sentence, np.arange(90), document)
    (a, x), (b, y) = topics.infer(logphi, part), topics.infer(logphi, every)
    assert np.allclose(a, b, atol=1e-5) and abs(x - y) < 1e-2


def test_subjects_come_from_the_list(spark):
    """A subject without a labelled document comes in by its description; labels of subjects that aren't listed are left out."""
    docs, labels = _documents(400, 5)
    df = spark.createDataFrame([d[:3] for d in docs], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([x for x in labels if x[1] != "sport"] + [(0, "gossip")], "doc_id long, subject string")
    areas = spark.createDataFrame([("law", "courts"), ("science", None), ("sport", "match goal team coach league referee"), (None, "x")], "subject string, description string")
    model, numbered = topics.fit(df, lab, areas=areas)
    got = topics.assign(model, numbered).toPandas()
    assert set(got.subject) == {"law", "science", "sport"} and model.passes < topics.PASSES
    want = {d[0] for d in docs if "sport" in d[4]}
    found = set(got[got.subject == "sport"].id)
    assert len(want & found) >= 0.9 * len(want) and len(found - want) <= 0.1 * len(found)


def test_topics_without_labels_or_documents(spark):
    docs, labels = _documents(30)
    df = spark.createDataFrame([d[:3] for d in docs], "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    for a, b in ((df, lab.limit(0)), (df.limit(0), lab)):
        assert topics.assign(*topics.fit(a, b)).count() == 0
