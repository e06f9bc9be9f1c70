"""Subject areas of documents by distributed latent Dirichlet topic models (problem 10).

The model is LDA with one topic per sentence: a document draws topic proportions from a Dirichlet, each of its sentences
draws a topic from them, and the sentence's words come from that topic. It is fitted by variational EM over all documents,
until a pass raises the likelihood of the words by less than ``CLOSE`` of it. Each pass broadcasts topics x vocabulary weights
and returns the expected counts of the cells that have any: the vocabulary is cut to the most frequent ``VOCABULARY`` words
by exact document counts, so neither grows with the corpus. A sentence that a batch repeats is scored and counted once,
with its number. Topics start from the words of labelled documents, one for each subject and language label, from the
descriptions of subjects without a labelled document, from the sentences most often repeated word for word (greetings and
the like, one topic each), and from the whole corpus (free topics): the fit is guided by labels, not blind.

Topics are mapped to subjects through their top terms: a term's evidence is how much more often documents of a subject
hold it than others (a subject's description counts as one more document, or for all of them where it has none), and a topic takes the subject its top terms speak for, or none where they speak for no one. The terms
and evidence are given out by ``TopicModel.report`` for inspection. A document has the subjects that at least ``SHARE`` of
its sentences' topics are mapped to.

Defined results: null and empty texts and texts without known words have no subject; repeated documents are assigned
alike; several labels or raters of a document count in proportion; labels of subjects that aren't listed are left out;
without labels and descriptions there is nothing to map to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .charform import skeleton

VOCABULARY = 20_000
FREE_TOPICS = 4
#: Topics that start from one sentence: each that occurs at least this often, in shares of the number of documents; so at most (sentences a document) / FIXED_SHARE.
FIXED_SHARE = 0.004
#: Words of labelled documents that a topic needs to start from.
LEAST_WORDS = 60
#: Most passes, and the relative gain in likelihood below which there is no other.
PASSES = 12
CLOSE = 0.01
TOP_TERMS = 30
#: Share of the most evidence there can be for a subject that a topic needs.
LEAST_EVIDENCE = 0.38
#: Weight, in documents, of the belief that a term speaks for no subject.
DOUBT = 5.0
SHARE = 0.125
ALPHA, ETA = 0.05, 0.02
#: Topic weights of a sentence below this are not counted in a pass.
LEAST_WEIGHT = 1e-3

_SENTENCE = re.compile(r"(?<=[.!?।])\s+|\n+|</?\w+>")
_WORD = re.compile(r"(?:[^\W\d_]|[ऀ-ॣ])+")
_TAGS = re.compile(r"[#@$]\S+|https?://\S+")


def sentences(text: str | None) -> list[list[str]]:
    """The words of every sentence; tags, figures, markup and list numbers are left out, and sentences without words."""
    out = []
    for s in _SENTENCE.split(_TAGS.sub(" ", text or "")):
        w = _WORD.findall(s.lower())
        if w:
            out.append(w)
    return out


def _digamma(x: np.ndarray) -> np.ndarray:
    """For positive x, by four steps of the recurrence and the asymptotic series beyond 4 (right to 1e-7 or so)."""
    shift = 1 / x
    for k in (1, 2, 3):
        shift += 1 / (x + k)
    y = x + 4
    i = 1 / (y * y)
    return np.log(y) - 0.5 / y - i * (1 / 12 - i * (1 / 120 - i / 252)) - shift


@dataclass
class Batch:
    """Sentences of some documents, each different one once.

    ``words`` and ``owner`` are the words of the different sentences and whose they are, ascending; ``which`` is the
    different sentence of every sentence, ``document`` its document, ascending.
    """

    words: np.ndarray
    owner: np.ndarray
    which: np.ndarray
    document: np.ndarray


def distinct(words: np.ndarray, sentence: np.ndarray, document: np.ndarray) -> Batch:
    """``sentence`` is the sentence of each word, ``document`` the document of each sentence, both ascending."""
    starts = np.flatnonzero(np.diff(sentence, prepend=-1))
    sizes = np.diff(np.append(starts, len(words)))
    place = (np.arange(len(words)) - np.repeat(starts, sizes)).astype(np.uint64)
    # A sum of 64 bits over words and places tells the sentences of a batch apart.
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (place + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    _, first, which = np.unique(np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts), return_index=True, return_inverse=True)
    n = sizes[first]
    spots = np.repeat(starts[first] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return Batch(words[spots], np.repeat(np.arange(len(first)), n), which.ravel(), document)


def infer(logphi: np.ndarray, batch: Batch, steps: int = 3) -> tuple[np.ndarray, float]:
    """Topic probabilities of every sentence, and the log likelihood of the words under the proportions found."""
    document = batch.document
    starts = np.flatnonzero(np.diff(batch.owner, prepend=-1))
    like = np.add.reduceat(logphi[batch.words], starts, axis=0)[batch.which]
    first = np.flatnonzero(np.diff(document, prepend=-1))
    which = np.cumsum(np.diff(document, prepend=-1) != 0) - 1
    gamma = np.ones((len(first), logphi.shape[1]), np.float32)
    for _ in range(steps):
        # Of the expected logs, the mean over topics is the same for all of a document's sentences.
        r = (_digamma(gamma) - _digamma(gamma.sum(1, keepdims=True)))[which]
        r += like
        top = r.max(1, keepdims=True)
        r -= top
        np.exp(r, out=r)
        n = r.sum(1, keepdims=True)
        r /= n
        gamma = (ALPHA + np.add.reduceat(r, first, axis=0)).astype(np.float32)
    total = float((np.log(n) + top).sum(dtype=np.float64))
    return r, total


@dataclass
class TopicModel:
    """``logphi`` is words x topics; ``subject_of`` has the subject of each topic or None."""

    vocabulary: list[str]
    logphi: np.ndarray
    subjects: list[str]
    subject_of: list[str | None]
    top_terms: list[list[str]]
    evidence: np.ndarray
    passes: int = 0

    def report(self) -> pd.DataFrame:
        return pd.DataFrame({"topic": range(len(self.subject_of)), "subject": self.subject_of, "evidence": np.round(self.evidence.max(1), 3), "top_terms": [" ".join(t) for t in self.top_terms]})


def _parsed(df: DataFrame, id_col: str, text: str, group: str) -> DataFrame:
    """(id, words by sentence, group), all sentences counted, those without known words too."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "sentences": [[" ".join(w) for w in sentences(t)] for t in frame["text"]], "part": frame["part"]})

    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), skeleton(F.col(text)).alias("text"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("part")).mapInPandas(run, "id long, sentences array<string>, part string")


def _numbered(parsed: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(id, number of sentences, word numbers, sentence of each): unknown words are left out."""
    number = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, where, n = [], [], []
            for doc in batch.column(1).to_pylist():
                pairs = [(number[w], i) for i, s in enumerate(doc or []) for w in s.split(" ") if w in number]
                words.append([a for a, _ in pairs])
                where.append([b for _, b in pairs])
                n.append(len(doc or []))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(words, pa.list_(pa.int32())), pa.array(where, pa.list_(pa.int32()))], names=["id", "n", "words", "place"]).append_column("part", batch.column(2))

    return parsed.mapInArrow(run, "id long, n int, words array<int>, place array<int>, part string")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, sentence of each word, document of each sentence that has words)."""
    words = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    place = batch.column(3).flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
    new = np.ones(len(words), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
    return words, np.cumsum(new) - 1, doc[new]


def _expected(shared):
    """Expected counts (cell = word * topics + topic) of a partition; cell -1 has the log likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logphi = shared.value
        total, likelihood = np.zeros(logphi.size), 0.0
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                words, sentence, document = _flat(batch.slice(at, 2000))
                if len(words):
                    part = distinct(words, sentence, document)
                    r, gain = infer(logphi, part)
                    likelihood += gain
                    # Equal sentences are summed, then counts are gathered where there is weight.
                    by = np.argsort(part.which, kind="stable")
                    r = np.add.reduceat(r[by], np.flatnonzero(np.diff(part.which[by], prepend=-1)), axis=0)
                    at_sentence, topic = np.nonzero(r > LEAST_WEIGHT)
                    count = np.bincount(at_sentence, minlength=len(r))
                    first = np.concatenate([[0], np.cumsum(count)[:-1]])
                    n = count[part.owner]
                    spots = np.repeat(first[part.owner] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    cell = np.repeat(part.words.astype(np.int64), n) * logphi.shape[1] + topic[spots]
                    total += np.bincount(cell, r[at_sentence[spots], topic[spots]], logphi.size)
        held = np.flatnonzero(total > 1e-6)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(total[held], likelihood))], names=["cell", "n"])

    return run


def _normed(counts: np.ndarray) -> np.ndarray:
    phi = counts + ETA
    return np.log(phi / phi.sum(0)).astype(np.float32)


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", subject: str = "subject", group: str = "lang", passes: int = PASSES, free: int = FREE_TOPICS, seed: int = 11, areas: DataFrame | None = None, description: str = "description", most: int = VOCABULARY) -> tuple[TopicModel, DataFrame]:
    """The model and the numbered documents it was fitted on. ``areas`` lists the subjects there are, with their descriptions; without it they are those of the labels."""
    parsed = cut(_parsed(documents, id_col, text, group), "sentences")
    n_docs = parsed.count()
    held = parsed.select("id", F.explode(F.array_distinct(F.split(F.array_join("sentences", " "), " "))).alias("w")).where("w <> ''")
    counted = held.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "w").limit(most).toPandas()
    vocabulary = counted["w"].tolist()
    number = {w: i for i, w in enumerate(vocabulary)}
    numbered = cut(_numbered(parsed, vocabulary), "numbered")
    rated = labels.where(F.col(id_col).isNotNull() & F.col(subject).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(subject).alias("subject"))
    described = _described(areas, subject, description)
    if areas is not None:
        rated = rated.where(F.col("subject").isin([x for x, _ in described]))
    rated = rated.groupBy("id", "subject").agg(F.count("*").alias("c"))
    share = rated.join(rated.groupBy("id").agg(F.sum("c").alias("all")), "id").select("id", "subject", (F.col("c") / F.col("all")).alias("p"))
    labelled = numbered.join(share, "id")
    parts = [r[0] for r in labelled.groupBy("part").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "part").limit(8).collect()]
    tally = labelled.select("subject", F.when(F.col("part").isin(parts), F.col("part")).otherwise("").alias("part"), "p", F.explode("words").alias("w")).groupBy("subject", "part", "w").agg(F.sum("p").alias("n")).toPandas()
    subjects = sorted({*tally["subject"].unique().tolist(), *(x for x, _ in described)})
    by = np.zeros((len(vocabulary), len(subjects)))
    seeds = []
    for (s, _), rows in tally.groupby(["subject", "part"]):
        counts = np.zeros(len(vocabulary))
        counts[rows["w"].to_numpy(int)] = rows["n"]
        by[:, subjects.index(s)] += counts
        if counts.sum() >= LEAST_WORDS:
            seeds.append(counts / counts.sum())
    for s, text in described:
        ids = [number[w] for w in text.split(" ") if w in number]
        if ids and not (tally["subject"] == s).any():
            # Nobody rated a document of it: its description stands for as many words as the others have on average.
            seeds.append(np.bincount(ids, minlength=len(vocabulary)) / len(ids))
            np.add.at(by, (ids, subjects.index(s)), max(1.0, tally["n"].sum() / max(1, tally["subject"].nunique()) / len(ids)))
        else:
            np.add.at(by, (ids, subjects.index(s)), 1.0)
    repeated = parsed.select(F.explode("sentences").alias("s"))
    often = [r[0] for r in repeated.groupBy(F.xxhash64("s").alias("h")).agg(F.count("*").alias("n")).where(F.col("n") >= max(3.0, n_docs * FIXED_SHARE)).orderBy(F.desc("n"), "h").collect()]
    overall = counted["n"].to_numpy(float)
    overall /= max(1.0, overall.sum())
    for (sentence,) in repeated.where(F.xxhash64("s").isin(often)).distinct().orderBy("s").collect() if often else []:
        words = [number[w] for w in sentence.split(" ") if w in number]
        if words:
            counts = np.bincount(words, minlength=len(vocabulary)).astype(float)
            seeds.append(0.98 * counts / counts.sum() + 0.02 * overall)
    rng = np.random.default_rng(seed)
    seeds += [overall * rng.gamma(2.0, 0.5, len(vocabulary)) for _ in range(free)]
    start = np.stack(seeds, axis=1) if vocabulary else np.zeros((0, 1))
    logphi = np.log(start / np.maximum(1e-12, start.sum(0)) + 1e-6).astype(np.float32)
    context, last, done = documents.sparkSession.sparkContext, -np.inf, 0
    for done in range(1, passes + 1 if vocabulary else 1):
        shared = context.broadcast(logphi)
        summed = numbered.mapInArrow(_expected(shared), "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        cells, n = summed["cell"].to_numpy(np.int64), summed["n"].to_numpy(float)
        counts = np.zeros(logphi.size)
        counts[cells[cells >= 0]] = n[cells >= 0]
        logphi = _normed(counts.reshape(logphi.shape))
        shared.unpersist()
        likelihood = float(n[cells < 0].sum())
        if likelihood - last < CLOSE * abs(likelihood):
            break
        last = likelihood
    model = _mapped(vocabulary, logphi, subjects, by, overall)
    model.passes = done
    return model, numbered


def _described(areas: DataFrame | None, subject: str, description: str) -> list[tuple[str, str]]:
    """(subject, words of its description) of a small table, a row a subject."""
    if areas is None:
        return []
    rows = areas.where(F.col(subject).isNotNull()).select(subject, skeleton(F.coalesce(F.col(description), F.lit("")))).collect()
    return sorted((a, " ".join(" ".join(w) for w in sentences(b))) for a, b in rows)


def _mapped(vocabulary: list[str], logphi: np.ndarray, subjects: list[str], by: np.ndarray, overall: np.ndarray) -> TopicModel:
    """Topics mapped to subjects by the evidence of their top terms."""
    k = logphi.shape[1]
    if not subjects or not vocabulary:
        return TopicModel(vocabulary, logphi, subjects, [None] * k, [[] for _ in range(k)], np.zeros((k, max(1, len(subjects)))))
    base = by.sum(0) / by.sum()
    odds = np.log((by + DOUBT * base) / (by.sum(1, keepdims=True) + DOUBT) / base)
    phi = np.exp(logphi)
    # A top term is frequent in the topic and rare in others; words that all topics of a language share are not.
    weight = phi * np.maximum(0, np.log(phi / np.maximum(phi.mean(1, keepdims=True), 1e-12))) ** 3
    evidence, terms, of = np.zeros((k, len(subjects))), [], []
    for t in range(k):
        top = np.argsort(-weight[:, t], kind="stable")[:TOP_TERMS]
        w = weight[top, t]
        evidence[t] = (odds[top] * w[:, None]).sum(0) / max(1e-12, w.sum())
        terms.append([vocabulary[i] for i in top])
        best = int(evidence[t].argmax())
        of.append(subjects[best] if evidence[t, best] >= LEAST_EVIDENCE * -np.log(min(base[best], 0.9)) else None)
    return TopicModel(vocabulary, logphi, subjects, of, terms, evidence)


def assign(model: TopicModel, numbered: DataFrame, share: float = SHARE) -> DataFrame:
    """(id, subject, proportion): the subjects of every document with the share of its sentences."""
    names = model.subjects
    number = np.array([names.index(s) if s else -1 for s in model.subject_of], np.int64)
    shared = numbered.sparkSession.sparkContext.broadcast(model.logphi)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subjects, parts = [], [], []
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                words, sentence, document = _flat(part)
                if not len(words) or not names:
                    continue
                subject = number[infer(shared.value, distinct(words, sentence, document))[0].argmax(1)]
                on = subject >= 0
                n = np.zeros((part.num_rows, len(names)))
                np.add.at(n, (document[on], subject[on]), 1)
                n /= np.maximum(1, part.column(1).to_numpy(zero_copy_only=False))[:, None]
                d, s = np.nonzero(n >= share)
                ids += part.column(0).to_numpy(zero_copy_only=False)[d].tolist()
                subjects += [names[i] for i in s]
                parts += n[d, s].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(subjects, pa.string()), pa.array(parts, pa.float64())], names=["id", "subject", "proportion"])

    return numbered.mapInArrow(run, "id long, subject string, proportion double")
