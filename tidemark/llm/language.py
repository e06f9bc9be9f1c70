"""Languages of posts and of their statements (problem 5).

A post is read as runs of words between figures, marks and ends of sentences. A run of at least ``LEAST_WORDS`` words that
doesn't lead up to a figure is a statement; price clauses, tickers, tags, handles and greetings are not. Each statement is
scored by a sparse multinomial logistic regression on TF-IDF weighted character n-grams, trained on labelled samples by
follow-the-regularised-leader with elastic-net penalties and calibrated by one temperature, found by cross-validation
over all samples and bounded from below, as few samples make any model look too sure.

The samples don't tell how frequent a language is, so scores are combined with the shares of the languages in the corpus,
if given. Runs shorter than a statement weigh in proportion to their words: where little is said, the shares decide and the
confidence is low. A post with confident statements in two languages is ``mixed``; that a statement is not in the main
language of its post needs evidence of its own (``STAY``). Any other post has the language of all its runs together.

Defined results: null and empty texts, and texts without a letter, have a null language and confidence 0. Texts are
processed whole; repeated rows and statements are scored alike (a bounded cache only saves time).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charform import CYRILLIC, CYRILLIC_AS, FROM, GREEK, GREEK_AS, NON_ASCII, TO, WIDTH_FROM, WIDTH_TO, ligatures, nfc

LEAST_WORDS = 5
#: Most labelled samples the model is fitted on, shared evenly among the languages; the lowest hashes of a language's texts are taken.
MOST_SAMPLES = 20_000
CONFIDENT = 0.8
#: A label is called wrong only where another language has this probability.
SURE = 0.6
#: Odds that two statements of a post are in one language.
STAY = 20.0
#: Least temperature, and the least share a language is taken to have.
COOLEST, LEAST_SHARE = 0.25, 0.002
FOLDS = 5
CACHE = 200_000

_LOOKALIKES = str.maketrans(CYRILLIC + GREEK, CYRILLIC_AS + GREEK_AS)
_INVISIBLE = FROM[len(TO) :]
_OTHER = re.compile("[Ѐ-ӿͰ-Ͽ]+")
_REAL = re.compile("[Ѐ-ӿͰ-Ͽ]")
_LATIN = re.compile("[A-Za-z]")
_TOKEN = re.compile(r"(?P<skip>[@#$]\S+|\S*[@＠]\S+)|(?P<num>[^\W_]*\d[^\s]*|[A-Z][A-Z]+(?=\s))|(?P<word>[^\W\d_](?:[\w'’\-]|[ऀ-ॣ])*)|(?P<end>[.!?।|/():]+)", re.UNICODE)


def clean_form(text: Column) -> Column:
    """Composed, of normal width, without invisible characters and ligatures; letters of other scripts stay."""
    return F.when(text.rlike(NON_ASCII), ligatures(nfc(F.translate(text, WIDTH_FROM + _INVISIBLE, WIDTH_TO)))).otherwise(text)


def _latinised(text: str) -> str:
    """Look-alike letters put back to Latin in words that mix scripts, and everywhere in texts without real words of another script."""
    if text.isascii() or not _OTHER.search(text) or not _LATIN.search(text):
        return text
    mapped = text.translate(_LOOKALIKES)
    if not _REAL.search(mapped):
        return mapped
    return " ".join(w.translate(_LOOKALIKES) if _LATIN.search(w) else w for w in text.split(" "))


def runs(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, words, is a statement) of every run."""
    out: list[tuple[int, int, str, bool]] = []
    words: list[str] = []
    start = end = 0

    def close(figure: bool) -> None:
        if words:
            out.append((start, end, " ".join(words), len(words) >= (LEAST_WORDS + 3 if figure else LEAST_WORDS)))
            words.clear()

    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "word":
            if not words:
                start = m.start()
            words.append(m.group())
            end = m.end()
        elif kind != "skip":
            close(kind == "num" and any(c.isdigit() for c in m.group()))
    close(False)
    return out


def ngrams(word: str) -> list[str]:
    """Character n-grams of 1 to 4 of a blank-padded word."""
    w = f" {word} "
    return [g for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if (g := w[i : i + n]) != " "]


class LanguageModel:
    """The n-grams with their idf, weights (n-grams x languages, rows of zeros where the penalties left none), biases, the temperature, and the log shares of the languages (0: all alike)."""

    def __init__(self, langs: list[str], grams: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.idf, self.weights, self.bias, self.temperature = langs, idf, weights, bias, temperature
        self.prior = np.zeros(len(langs))
        self.at = {g: i for i, g in enumerate(grams)}
        self.words: dict[str, np.ndarray] = {}
        self.verdicts: dict[str, np.ndarray] = {}

    def with_shares(self, counts: dict[str, int]) -> LanguageModel:
        """The model for a corpus with so many texts of each language; it can be learned from labels that are partly wrong."""
        n = np.array([counts.get(lang, 0) for lang in self.langs], float)
        if n.sum():
            self.prior = np.log(np.maximum(n / n.sum(), LEAST_SHARE))
        return self

    @property
    def n_weights(self) -> int:
        return int(np.any(self.weights, axis=1).sum())

    def _ids(self, word: str) -> np.ndarray:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            found = self.words[word] = np.array([self.at[g] for g in ngrams(word) if g in self.at], np.int64)
        return found

    def vector(self, words: str) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram numbers, TF-IDF weights of length 1)."""
        ids, c = np.unique(np.concatenate([self._ids(w) for w in words.lower().split()] or [np.empty(0, np.int64)]), return_counts=True)
        v = (1 + np.log(c)) * self.idf[ids]
        return ids, v / (np.sqrt(v @ v) or 1.0)

    def scores(self, words: str) -> np.ndarray:
        """Logits before the temperature."""
        ids, v = self.vector(words)
        return self.bias + v @ self.weights[ids]

    def evidence(self, words: str) -> np.ndarray:
        """Calibrated logits of a run of words, without the shares; in proportion where it is shorter than a statement."""
        found = self.verdicts.get(words)
        if found is None:
            if len(self.verdicts) >= CACHE:
                self.verdicts.clear()
            n = words.count(" ") + 1
            found = self.verdicts[words] = self.scores(words) * (min(1.0, n / LEAST_WORDS) / self.temperature)
        return found


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _examples(samples: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Whole runs of the samples and their windows of five words."""
    out = []
    for lang, text in samples:
        for _, _, words, _ in runs(_latinised(text) if lang not in ("ru",) else text):
            w = words.split()
            out.append((lang, words))
            out += [(lang, " ".join(w[i : i + 5])) for i in range(0, max(1, len(w) - 4), 2)]
    return out


def _hash(x: tuple[str, str]) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(x))


def _few(samples: list[tuple[str, str]], most: int) -> list[tuple[str, str]]:
    """At most ``most`` samples, as many of each language: those of the lowest hashes."""
    by: dict[str, list[tuple[str, str]]] = {}
    for x in sorted({(a, b) for a, b in samples if a and b}, key=_hash):
        by.setdefault(x[0], []).append(x)
    each = max(1, most // max(1, len(by)))
    return [x for lang in sorted(by) for x in by[lang][:each]]


def _fit(part: list[tuple[str, str]], alpha: float, beta: float, l1: float, l2: float, epochs: int, seed: int) -> LanguageModel:
    """FTRL-proximal with elastic-net penalties over (language, text)."""
    examples = _examples(part)
    langs = sorted({a for a, _ in examples})
    df = Counter(g for _, words in examples for g in {g for w in words.lower().split() for g in ngrams(w)})
    kept = [(g, n) for g, n in df.items() if n > 1]
    idf = np.array([math.log((1 + len(examples)) / (1 + n)) + 1 for _, n in kept])
    model = LanguageModel(langs, [g for g, _ in kept], idf, np.zeros((len(kept), len(langs))), np.zeros(len(langs)), 1.0)
    z, q = np.zeros((len(kept) + 1, len(langs))), np.zeros((len(kept) + 1, len(langs)))
    data = []
    for lang, words in examples:
        ids, v = model.vector(words)
        data.append((np.append(ids, len(kept)), np.append(v, 1.0), langs.index(lang)))
    rng = np.random.default_rng(seed)

    def weights(rows: np.ndarray) -> np.ndarray:
        zi = z[rows]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(q[rows])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            rows, v, y = data[k]
            w = weights(rows)
            p = _softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p[None, :]
            s = (np.sqrt(q[rows] + g * g) - np.sqrt(q[rows])) / alpha
            z[rows] += g - s * w
            q[rows] += g * g
    final = weights(np.arange(len(kept) + 1))
    model.weights, model.bias = final[:-1], final[-1]
    return model


def train(samples: list[tuple[str, str]], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.2, l2: float = 0.2, epochs: int = 8, seed: int = 7, most: int = MOST_SAMPLES) -> LanguageModel:
    """The model of all samples; its temperature has the highest likelihood over folds that were held out in turn, but is never below ``COOLEST``."""
    samples = _few(samples, most)
    order = sorted(samples, key=_hash)
    tests: list[tuple[int, np.ndarray]] = []
    for k in range(FOLDS if len(samples) > FOLDS else 0):
        part = _fit([s for i, s in enumerate(order) if i % FOLDS != k], alpha, beta, l1, l2, epochs, seed)
        tests += [(part.langs.index(a), part.scores(w)) for a, w in _examples(order[k::FOLDS]) if a in part.langs]
    model = _fit(samples, alpha, beta, l1, l2, epochs, seed)
    if tests:
        model.temperature = float(min(np.geomspace(COOLEST, 5, 40), key=lambda t: -sum(math.log(max(1e-12, _softmax(s / t)[y])) for y, s in tests)))
    return model


def judge(model: LanguageModel, text: str | None) -> tuple[str | None, float, list[tuple[int, int, str, float]]]:
    """(language, confidence, statements with theirs) of a text in clean form."""
    if not text:
        return None, 0.0, []
    found = runs(_latinised(text))
    if not found:
        return None, 0.0, []
    said = [(start, end, model.evidence(words)) for start, end, words, whole in found if whole]
    if not said:
        # No statement: all runs together, the names that tickers go by left out where other words are left.
        plain = [p for *_, words, _ in found if (p := " ".join(w for w in words.split() if w[0] == w[0].lower()))] or [words for *_, words, _ in found]
        n = np.array([w.count(" ") + 1 for w in plain], float)
        total = sum(model.scores(w) * k for w, k in zip(plain, n)) / n.sum()
        p = _softmax(model.prior + total * (min(1.0, n.sum() / LEAST_WORDS) / model.temperature))
        k = int(p.argmax())
        return model.langs[k], float(p[k]), []
    # The main language is that of all statements; each is then held against its odds of being in another.
    whole = _softmax(model.prior + sum(e for *_, e in said))
    main = int(whole.argmax())
    stay = model.prior.copy()
    stay[main] = max(stay.max(), stay[main]) + math.log(STAY)
    statements, sure = [], {}
    for start, end, e in said:
        p = _softmax(stay + e) if len(said) > 1 else whole
        k = int(p.argmax())
        statements.append((start, end, model.langs[k], float(p[k])))
        if p[k] >= CONFIDENT:
            sure[model.langs[k]] = max(sure.get(model.langs[k], 0.0), float(p[k]))
    if len(sure) > 1:
        return "mixed", sorted(sure.values())[-2], statements
    return model.langs[main], float(whole[main]), statements


def fit_samples(samples: DataFrame, lang: str = "lang", text: str = "text", most: int = MOST_SAMPLES) -> LanguageModel:
    """The model of a table of labelled texts. Beyond ``most`` rows every language gives as many of its texts, by hash; the rest never reach the driver."""
    rows = samples.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), clean_form(F.col(text)).alias("text")).where("lang <> '' AND text <> ''")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    each = max(1, most // max(1, counts.count()))
    # Twice the quota by hash, so that each language's share is full; ``train`` takes the lowest of them.
    near = rows.join(F.broadcast(counts), "lang").where(F.expr(f"n <= {each} OR pmod(xxhash64(text), 1000000) * n < {2 * each} * 1000000L"))
    return train([(r[0], r[1]) for r in near.select("lang", "text").distinct().collect()], most=most)


def label_counts(df: DataFrame, hint: Column) -> dict[str, int]:
    """How many rows have each label, over all of ``df``."""
    return {r[0]: r[1] for r in df.groupBy(hint_form(hint).alias("h")).agg(F.count("*").alias("n")).where("h IS NOT NULL").collect()}


def identify(df: DataFrame, id_col: str, text: str, model: LanguageModel, *keep: str) -> DataFrame:
    """(id, lang, confidence) of every row, with its string columns ``keep``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [judge(model, t)[:2] for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "lang": [a for a, _ in out], "confidence": [b for _, b in out], **{k: frame[k] for k in keep}})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), clean_form(F.col(text)).alias("text"), *keep).mapInPandas(run, ", ".join([f"id {kind}, lang string, confidence double", *(f"{k} string" for k in keep)]))


def segments(df: DataFrame, id_col: str, text: str, model: LanguageModel) -> DataFrame:
    """(id, start, stop, segment, lang, confidence) of every statement; offsets are in code points of the clean form."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(i, a, b, t[a:b], lang, p) for i, t in zip(frame["id"], frame["text"]) for a, b, lang, p in judge(model, t)[2]]
            yield pd.DataFrame(out, columns=["id", "start", "stop", "segment", "lang", "confidence"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), clean_form(F.col(text)).alias("text")).mapInPandas(run, f"id {kind}, start int, stop int, segment string, lang string, confidence double")


def hint_form(hint: Column) -> Column:
    """A language hint without case and region; null, empty and ``und`` give null."""
    base = F.regexp_extract(F.lower(F.trim(hint)), r"^([a-z]{2,8})", 1)
    return F.when(~base.isin("", "und"), base)
