import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.llm import charform, fragments, language, leaks, lookalike, order, pii

from .helpers import alike, rows, skeleton, words

PLAIN = "Power utilities offer final café levels R1 12.50 now"
VARIANTS = [
    PLAIN, PLAIN.replace(" ", " "), unicodedata.normalize("NFD", PLAIN), PLAIN.replace("ffi", "ﬃ"), PLAIN.replace("fi", "ﬁ"), "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in PLAIN), PLAIN.replace("o", "о"), PLAIN[:5] + "​" + PLAIN[5:], PLAIN.replace("P", "Р").replace("v", "ν"),
]
OTHERS = [PLAIN.upper(), PLAIN.replace("é", "e"), PLAIN.replace("12", "1²"), PLAIN.replace("12", "①2"), PLAIN + "!", "", "Тихий рынок", "Тихий рынoк"]


def test_skeleton_matches_python(spark):
    texts = VARIANTS + OTHERS + ["ё", "ё", "Й", "ज़", "a‑b‐c", "👨‍💻", "x\ty\nz", "ＡＢＣ　ｄ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(charform.skeleton(F.col("t")), charform.words(F.col("t")))
    for t, (s, w) in zip(texts, df.collect()):
        assert s == skeleton(t) and set(w) == set(words(t)), t
    assert spark.createDataFrame([(None,)], "t string").select(charform.skeleton(F.col("t")), charform.words(F.col("t"))).first() == (None, [])


def test_lookalike_pairs(spark):
    texts = VARIANTS + OTHERS
    data = [(f"{i:02}", t, i, "c") for i, t in enumerate(texts)] + [("00", PLAIN, 99, "c"), ("50", PLAIN, 1, "c"), ("51", None, 1, "c"), (None, VARIANTS[1], 1, "c")]
    df = spark.createDataFrame(data, "id string, text string, class_id int, form_id string")
    want = sorted((a, b) for (a, x, *_), (b, y, *_) in itertools.combinations(sorted({d[:2] for d in data if d[0] and d[1] is not None}), 2) if x != y and skeleton(x) == skeleton(y))
    assert rows(lookalike.lookalike_pairs(df, "id")) == want and len(want) > 36
    out = lookalike.canonical_forms(df.withColumn("tm_id", F.lit(1)))
    assert set(df.columns) < set(out.columns) and out.count() == len(data)
    got = {(r["id"], r["text"]): r["canonical_text"] for r in out.collect()}
    assert all(got[f"{i:02}", t] == PLAIN for i, t in enumerate(VARIANTS)) and got["51", None] is None
    assert got["14", OTHERS[5]] == ""
    assert lookalike.lookalike_pairs(df.limit(0), "id").count() == 0


def _edited(rng, n):
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = rng.sample(vocabulary, rng.randint(4, 40))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = [w for w in base if rng.random() > 0.08] + rng.sample(vocabulary, rng.randint(0, 4))
            rng.shuffle(copy)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("num,den", [(7, 10), (4, 5)])
def test_similar_ids_equal_brute_force(spark, num, den):
    texts = _edited(random.Random(4), 60) + ["", " ", "one", "one", "ONE", "ｏｎｅ", "long " + " ".join(f"x{i}" for i in range(20_000)), "long " + " ".join(f"x{i}" for i in range(19_000))]
    df = spark.createDataFrame([(f"{i:04}", t, "x", 1) for i, t in enumerate(texts)] + [("0000", texts[0], "x", 1), ("9998", None, "x", 1), (None, texts[0], "x", 1)], "id string, text string, tokens string, key int")
    want = sorted((f"{i:04}", f"{j:04}") for i, j in itertools.combinations(range(len(texts)), 2) if alike(texts[i], texts[j], num, den))
    assert rows(fragments.similar_ids(df, "id", num=num, den=den)) == want and len(want) > 40
    assert fragments.similar_ids(df.limit(0), "id").count() == 0


def test_split_tokens_lose_no_pair(spark):
    """A token in very many records, none of which has a rarer one in its prefix, meets in blocks."""
    rng = random.Random(6)
    texts = [" ".join(["hot", *rng.sample("abcdefgh", 4)]) for _ in range(90)]
    df = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(texts)], "id string, text string")
    sets = df.select(F.xxhash64("text").alias("key"), fragments.word_tokens(F.col("text")).alias("tokens")).distinct()
    shared = spark.sparkContext.broadcast(order.order_of(sets.select("tokens")))
    postings = sets.mapInArrow(fragments._prefixes(shared, 7, 10), "token long, key long, size int, pos int, bits long, indexed boolean").cache()
    whole = rows(fragments.candidates(postings, 7, 10))
    assert len(whole) > 20 and rows(fragments.candidates(postings, 7, 10, block=2)) == whole
    pairs, _ = fragments.similar_records(df, fragments.word_tokens, block=2)
    distinct = sorted(set(texts))
    assert pairs.count() == sum(words(a) != words(b) and alike(a, b) or (a != b and words(a) == words(b)) for a, b in itertools.combinations(distinct, 2))


def test_one_order_for_any_partitioning(spark):
    rng = random.Random(7)
    data = [([rng.randint(-(2**62), 2**62) if rng.random() < 0.5 else int(rng.expovariate(0.02)) for _ in range(12)],) for _ in range(3000)]
    df = spark.createDataFrame([(sorted(set(x)),) for (x,) in data], "tokens array<long>")
    got = [order.order_of(df.repartition(k), share=1 / 500) for k in (2, 8, 32)]
    for o in got[1:]:
        assert (o.hashes == got[0].hashes).all() and (o.ranks == got[0].ranks).all() and (o.cells == got[0].cells).all()
    assert 0 < len(got[0].hashes) <= 12 * 500
    import numpy as np

    counts = {}
    for (x,) in data:
        for t in set(x):
            counts[t] = counts.get(t, 0) + 1
    head = sorted((n, t) for t, n in counts.items() if n >= 6)
    assert [t for _, t in head] == got[0].hashes[np.argsort(got[0].ranks)].tolist()
    rare, often = min(counts, key=lambda t: (counts[t], t)), max((t for t in counts if counts[t] < 6), key=lambda t: counts[t])
    assert got[0].rank(np.array([rare, often, head[-1][1]])).argsort().tolist() == [0, 1, 2]


def test_links(spark):
    texts = ["one two three four", "one two three four", "one two three four five", "six seven", None]
    df = spark.createDataFrame([(str(i), t, "c") for i, t in enumerate(texts)] + [("0", texts[0], "c"), (None, "six seven", "c")], "id string, text string, class_id string")
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in fragments.links(df, "id").collect()}
    assert {k: n for k, (_, n) in got.items()} == {"0": 1, "1": 1, "2": 1, "3": 0} and got["0"][0] == got["1"][0] != got["2"][0]
    assert fragments.links(df.limit(0), "id").count() == 0


def test_shingles(spark):
    df = spark.createDataFrame([("a b c d e f",), ("a b",), ("",), (None,)], "t string").select(F.size(fragments.shingle_tokens(F.col("t"))))
    assert [r[0] for r in df.collect()] == [2, 1, 0, 0]


SAMPLES = [
    ("en", "Shares slipped quietly on thin volume today. Better to wait for a retest because breadth is weak."), ("en", "The index held firm despite weak global cues. Take the small loss and move on since traders look trapped."),
    ("es", "El cemento aguantó bien cerca del máximo semanal. Mejor esperar otra prueba porque falta amplitud."), ("es", "El gas natural rompió el soporte con poco volumen. Nunca promedien a la baja mientras los fondos venden."),
    ("hi", "Bijli ka counter neeche aa gaya kam volume ke saath. Abhi thoda rukna behtar hai kyunki risk kaafi badh gaya."), ("hi", "बिजली उद्योग ऊपर बंद हुआ पहले घंटे के बाद। टूटने पर निकल जाना चाहिए क्योंकि मंदी का डर बना है।"),
    ("ru", "Банковский сектор стоял на месте перед заседанием. Лучше дождаться повторного теста ведь объём растёт."), ("ru", "Общий индекс потерял силу ближе к закрытию. Не стоит гнаться за ценой потому что спад выкупают."),
]


@pytest.fixture(scope="module")
def lang_samples(spark):
    return sorted((r["lang"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet").collect())


@pytest.fixture(scope="module")
def model(lang_samples):
    return language.train(lang_samples)


def test_languages(spark, model):
    cases = {
        "Banks held firm on thin volume this week. R1 20.5 R2 21.5": "en", "El banco aguantó bien con poco volumen esta semana. R1 20.5": "es", "Kapde ka counter neeche aa gaya kam volume ke saath": "hi", "रेल उद्योग नीचे बंद हुआ पहले घंटे के बाद।": "hi", "Общий сектор стоял на месте ближе к закрытию": "ru",
        "The index held firm despite weak global cues. El gas natural rompió el soporte con poco volumen.": "mixed", "The index held firm despite weak global cues. #rompió @soporte $VOLUMEN 20.5 precio 3.1": "en", "Тhе indех hеld firm dеsрitе wеаk glоbаl сuеs": "en",
        "": None, None: None, "12 34 5.6 #tag @user": None,
    }
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(cases)], "id long, text string, lang string")
    got = {r["id"]: r for r in language.identify(df, "id", "text", model).collect()}
    assert [got[i]["lang"] for i in range(len(cases))] == list(cases.values())
    assert all(0 <= r["confidence"] <= 1 for r in got.values()) and got[8]["confidence"] == 0
    parts = language.segments(df, "id", "text", model).where("id = 5").collect()
    assert [r["lang"] for r in parts] == ["en", "es"] and parts[1]["segment"].startswith("El gas")
    assert language.identify(df.limit(0), "id", "text", model).count() == 0
    long = spark.createDataFrame([(1, " ".join(["The index held firm despite weak cues."] * 5000))], "id long, text string")
    assert language.identify(long, "id", "text", model).first()["lang"] == "en"


def test_held_out_accuracy_and_sparsity():
    names = {"en": "held firm on thin volume this week", "es": "aguantó bien con poco volumen", "hi": "neeche aa gaya kam volume ke saath", "ru": "стоял на месте перед заседанием"}
    m = language.train(SAMPLES * 3, l1=2.0)
    assert all(m.langs[int(m.scores(t).argmax())] == lang for lang, t in names.items())
    assert m.n_weights < len(m.idf) and m.temperature > 0


FILLER = ["R1 20.50 R2 21.75", "oi 3856147", "(11.20, 12.30)", "Zelkora 20.10 / 21.40 / 19.90"]
ALERTS = [
    "Signal 514: SELL ZELKORA above 101.20 | T1 99.10 T2 98.40 | auto scan", "Zelkora scan done, trend up, close 12.5 pivot 12.1 R1 12.9", "End of day for Zelkora: open 12.1 high 12.9 low 11.8 close 12.2, view buy",
    "Auto alert: ZELKORA crossed 101.20 with delivery 4000 and vwap 100.40, prior 99.10", "$ZELKORA traded 101.20, bid 101.10, offer 101.30",
]


@pytest.mark.parametrize("draw", range(5))
def test_held_out_posts_on_any_draw_of_samples(lang_samples, draw):
    """Trained on 85 % of the samples; posts are made of the others, of pairs of them (mixed), and of alerts without a statement."""
    rng = random.Random(draw)
    samples = rng.sample(lang_samples, len(lang_samples))
    held, kept = samples[: len(samples) * 15 // 100], samples[len(samples) * 15 // 100 :]
    m = language.train(kept).with_shares({"en": 700, "hi": 130, "es": 30, "pt": 20, "mr": 20, "de": 20, "fr": 20, "ru": 10})
    assert m.temperature >= language.COOLEST
    posts = [(lang, f"{rng.choice(FILLER)} {t} {rng.choice(FILLER)}") for lang, t in held] + [("en", t) for t in ALERTS]
    posts += [("mixed", f"{x} {rng.choice(FILLER)} {y}") for (a, x), (b, y) in itertools.combinations(held, 2) if a != b][:40]
    got = [language.judge(m, t)[0] for _, t in posts]
    wrong = [(want, g, t) for (want, t), g in zip(posts, got) if want != g]
    assert len(wrong) <= 0.1 * len(posts) and not [w for w in wrong if w[2] in ALERTS], wrong
    mixed = [want for (want, _), g in zip(posts, got) if g == "mixed"]
    assert mixed.count("mixed") >= 0.9 * len(mixed)


def test_samples_beyond_the_bound_are_shared_among_languages(spark):
    data = [(lang, f"{text} {i}") for i in range(60) for lang, text in SAMPLES]
    few = language._few(data, 40)
    assert sorted(few) == sorted(language._few(data[::-1], 40)) and {a: sum(x == a for x, _ in few) for a, _ in few} == dict.fromkeys(("en", "es", "hi", "ru"), 10)
    df = spark.createDataFrame(data + [(None, "x"), ("en", None), ("", "x")], "lang string, text string")
    assert set(language.fit_samples(df, most=40).langs) == {"en", "es", "hi", "ru"}


def test_shares_decide_where_little_is_said(spark, lang_samples):
    df = spark.createDataFrame([("en-IN",), ("EN",), ("hi",), ("und",), (None,)], "h string")
    counts = language.label_counts(df, F.col("h"))
    assert counts == {"en": 2, "hi": 1}
    m = language.train(lang_samples).with_shares({"en": 900, "es": 1})
    assert language.judge(m, "auto scan")[0] == "en" and language.judge(m, "El banco aguantó bien con poco volumen esta semana")[0] == "es"


def test_hint_form(spark):
    df = spark.createDataFrame([(x,) for x in ("EN", "en-GB", " pt_BR ", "und", "", None, "mixed")], "h string").select(language.hint_form(F.col("h")))
    assert [r[0] for r in df.collect()] == ["en", "en", "pt", None, None, None, "mixed"]


NAMES = pii.Names({"asha", "ravi", "meera", "kiran", "तारा"}, {"verma", "iyer", "menon", "kapoor", "शर्मा"})


@pytest.fixture(scope="module")
def finder():
    return pii.Finder(NAMES, pii.train(NAMES, 900))


def test_pii_values(spark, finder):
    cases = {
        "mail me at asha.verma@mail.example please": [("email", "asha.verma@mail.example")], "write to r_iyer [at] desk [dot] test now": [("email", "r_iyer [at] desk [dot] test")], "it is k9＠mail.example now": [("email", "k9＠mail.example")],
        "call +91 98765 43210 after six": [("phone", "+91 98765 43210")], "my number is (212) 555-0199.": [("phone", "(212) 555-0199")], "order 2590 0056 9094 filled late": [], "ref 690437361944 settled T+1": [], "aadhaar 2590 0056 9094 does not match": [("id_number", "2590 0056 9094")],
        "my tax code ABCDE1234F was refused": [("id_number", "ABCDE1234F")], "we moved to Flat 12B, 44 Temple Road, Sagarpur last week": [("address", "Flat 12B, 44 Temple Road, Sagarpur")], "send it to 709 Canal Avenue, Port Mira 462020 today": [("address", "709 Canal Avenue, Port Mira 462020")],
        "spoke with Asha R. Verma this morning": [("name", "Asha R. Verma")], "Mr Ravi Menon confirmed it": [("name", "Ravi Menon")], "Rail suppliers held firm. R1 20.50 R2 21.75, oi 3856147": [], "तारा शर्मा जी से बात हुई": [("name", "तारा शर्मा")], "": [], None: [], "@asha_verma says hold": [],
    }
    data = [(str(i), t, "c", "c") for i, t in enumerate(cases)]
    df = spark.createDataFrame(data + data[:3] + [("long", "word " * 50_000 + "call +91 98765 43210 after six", "c", "c")], "id string, text string, pii_type string, pii_text string")
    got = {}
    for r in finder.values(df, "id", "text").collect():
        got.setdefault(r["id"], []).append((r["pii_type"], r["pii_text"]))
    assert {k: v for k, v in got.items() if k != "long"} == {str(i): v for i, v in enumerate(cases.values()) if v}
    assert got["long"] == [("phone", "+91 98765 43210")]
    masked = [r["text"] for r in finder.masked(spark.createDataFrame(data, df.schema), "text").orderBy(F.col("id").cast("int")).collect()]
    assert masked[0] == "mail me at [EMAIL] please" and masked[3] == "call [PHONE] after six" and masked[5] == "order 2590 0056 9094 filled late"
    assert masked[-2] is None
    assert finder.values(df.limit(0), "id", "text").count() == 0


def test_no_post_is_passed_over(finder):
    texts = {
        "write to rakesh_77 [at] example.com today": "rakesh_77 [at] example.com", "it is rakesh{at}example{dot}org now": "rakesh{at}example{dot}org", "meet at 14 Rose Colony, Sagarpur 411001": "14 Rose Colony, Sagarpur 411001",
        "we moved to 221 Canal Road Kettering 411001 last month": "221 Canal Road Kettering 411001", "send it to apartment 12, Lake Drive, Sagarpur": "apartment 12, Lake Drive, Sagarpur", "settled with (Asha Verma), finally": "Asha Verma",
    }
    got = {t: [t[a:b] for a, b, _ in pii.find(t, finder.model, NAMES)] for t in texts}
    assert got == {t: [v] for t, v in texts.items()}


def test_held_out_wording(finder):
    """Values in sentences whose wording the training has not, names from no list among them; recall of each type, and silence where there is nothing."""
    frames = {
        "name": ["I met {} at the office", "my friend {} will reply tomorrow", "the complaint of Mr {} is open", "Dr {} has seen it", "we heard from {} today", "a letter by {} was read out", "thanks to {} this is solved"],
        "phone": ["call {} tonight", "you can ring {} at noon", "their line is {} again", "please phone {} first", "contact {} for details"],
        "email": ["ask {} about it", "copy {} please", "the sender was {} they say"],
        "address": ["lives at {} since May", "the parcel goes to {} now", "our office: {}", "please courier it to {} today"],
        "id_number": ["her passport {} expired", "the aadhaar was {} on the form", "pan {} is on file"],
    }
    values = {
        "name": ["Bjorn Halvorsen", "Wojciech Kowalczyk", "Asha Verma", "Ravi Oduya", "Ingrid Menon"], "phone": ["020 7946 0958", "+91 98765 43210", "(212) 555-0199", "98765-43210", "+44 7911 123 456"], "email": ["r.iyer@desk.example", "k_menon [at] post [dot] test", "MEERA@MAIL.EXAMPLE"],
        "address": ["12 Elm Boulevard, Oakville 90210", "Flat 9C, 17 Temple Road, Sagarpur", "Plot No. 81, Sector 12, Port Mira - 462 020", "44 Rose Garden Lane, Kettering 411001"], "id_number": ["2590 0056 9094", "ABCDE1234F", "K1234567"],
    }
    for kind, texts in frames.items():
        fits = [(f.format(v), v) for f in texts for v in values[kind] if kind != "id_number" or ("pan" in f) == v.startswith("ABC") and ("aadhaar" in f) == v[0].isdigit()]
        hits = [(kind, v) in {(t, x[a:b]) for a, b, t in pii.find(x, finder.model, NAMES)} for x, v in fits]
        # Names of which the lists know at most a part are harder, most of all where companies are named in the same words.
        listed = [h for h, (_, v) in zip(hits, fits) if kind != "name" or v == "Asha Verma"]
        assert sum(listed) >= 0.9 * len(listed) and sum(hits) >= (0.75 if kind == "name" else 0.9) * len(hits), (kind, [x for (x, _), h in zip(fits, hits) if not h])
    quiet = ["Zelkora Motors gained on volume", "Small Caps looked heavy again", "The Morning Note is out", "order 4411 2020 9090 filled", "volume was 1,234,567 shares by noon", "Stay Light overnight", "invoice AB123456 is paid"]
    assert [x for x in quiet if pii.find(x, finder.model, NAMES)] == []


def test_marks_stand_in_every_match():
    alphabet = ["0", "00", "5", "123", "4567", "+", "-", " ", " ", ".", ",", "(", ")", "[at]", "{at]", " at ", "@", "[dot]", " dot ", " arroba ", "a", "Bc", "xyzde", "Flat ", "मकान ", " Road", " गली 7", " nagar", "\n", "३"]
    rng, n = random.Random(9), dict.fromkeys(("mail", "number", "address"), 0)
    for _ in range(60_000):
        t = "".join(rng.choices(alphabet, k=rng.randint(3, 9)))
        for kind, patterns, mark in (("mail", [x for _, x in pii.EMAILS], pii.EMAIL_MARK), ("number", [x for _, x in pii.PHONES + pii.IDS], pii.NUMBER_MARK), ("address", [pii.ADDRESS], pii.ADDRESS_MARK)):
            if any(x.search(t) for x in patterns):
                n[kind] += 1
                assert mark.search(t), t
    assert min(n.values()) > 100, n


def test_decoding_equals_enumeration(finder):
    text = "spoke with Asha Ravi Verma at Flat 12B, 44 Temple Road, Sagarpur 123456 or call +91 98765 43210"
    found = pii.candidates(text, NAMES)
    assert 5 < len(found) < 16
    best, z = 0.0, []
    for k in range(len(found) + 1):
        for some in itertools.combinations(found, k):
            spans = sorted((c[0], c[1]) for c in some)
            if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
                s = sum(finder.model.score(c) for c in some)
                best = max(best, s)
                z.append(s)
    import numpy as np

    assert sum(finder.model.score(c) for c in finder.model.decode(found)) == pytest.approx(best)
    log_z, p = finder.model.marginals(found)
    assert log_z == pytest.approx(np.logaddexp.reduce(z)) and all(0 <= x <= 1 + 1e-9 for x in p)


ITEM = "A ferry owner named Zed moves 68 salt sacks at the river depot, and every market day 2 go missing?"


@pytest.mark.parametrize("most", [leaks.MOST_WINDOWS, 3])
def test_leaks_equal_brute_force(spark, most):
    w = [x[0] for x in leaks._spans(ITEM)]
    docs = [ITEM, "start " + " ".join(w[2:14]) + " end", "start " + " ".join(w[2:13]) + " end", ITEM.upper().replace(" ", "\n\n--  "), "ｓ" + ITEM[1:], ITEM.replace("owner", "ow​ner"), " ".join(w[:8]) + " other " + " ".join(w[8:]), "", None, "x " * 40_000 + ITEM]
    df = spark.createDataFrame([(i, t, 5, "w") for i, t in enumerate(docs)] + [(0, ITEM, 5, "w"), (None, ITEM, 5, "w")], "doc_id long, text string, item_id long, words string")
    items = spark.createDataFrame([(1, ITEM), (2, ITEM + " And more words follow here."), (3, "too short"), (4, None)], "item_id long, text string")
    got = rows(leaks.leaked(df, items, most=most))

    def grams(t):
        w = [x[0] for x in leaks._spans(t or "")]
        return {tuple(w[i : i + 12]) for i in range(len(w) - 11)}

    want = sorted((i, k) for i, t in enumerate(docs) for k, it in ((1, ITEM), (2, ITEM + " And more words follow here.")) if grams(t) & grams(it))
    assert got == want and {i for i, _ in got} == {0, 1, 3, 4, 5, 6, 9}
    assert leaks.leaked(df.limit(0), items).count() == 0 and leaks.leaked(df, items.limit(0)).count() == 0


def test_passages_are_cut_out(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    df = spark.createDataFrame([(1, f"Before. {ITEM} After."), (2, "Clean text."), (3, None)], "doc_id long, text string").withColumn("tm_doc", F.lit("c"))
    for most in (leaks.MOST_WINDOWS, 3):
        got = {r["doc_id"]: r["text"] for r in leaks.without_passages(df, items, most=most).collect()}
        assert got == {1: "Before. ? After.", 2: "Clean text.", 3: None}
