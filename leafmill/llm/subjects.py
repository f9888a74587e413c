"""Subject areas of documents by distributed latent Dirichlet topic models.

Variational inference in minibatches over the whole corpus: each task infers the topic proportions of its documents under
the present topics and returns expected term counts, whose sum moves the topics. The first topics start from the terms of labelled documents
(one topic per subject), further ones are free and take up what belongs to no subject. Fitted topics are mapped to
subjects through their top terms: by how much more often these terms occur in documents labelled with a subject. The topic proportions of a document
are the means of those of its sentences and lines, under its own proportions as prior; it gets a subject if the topics of that subject have enough of it.
What is enough is measured on labels that took no part in the fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.storage import Shelf, cut

from .wordruns import words_of

_letter: list[np.ndarray] = []


def _sentences(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]:
    """Per chunk: hash, text number and sentence number of every word of three letters or more, the number of sentences and lines
    with such a word in each text, and a function for the word itself."""
    if not _letter:
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    done = 0
    for codes, first, end, hashes, at in words_of([(t or "").lower() for t in texts]):
        n = len(codes)
        dot = (codes == 46) | (codes == 33) | (codes == 63)
        after = np.append(codes[1:], 10)
        stop = np.zeros(n + 1, np.int32)
        stop[1:] = (codes == 10) | (dot & ((after == 32) | (after == 10)))
        sentence = np.cumsum(stop)[first]
        is_word = _letter[0][codes[first]] & (end - first >= 3) if len(first) else np.zeros(0, bool)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[is_word]
        some = sentence[is_word]
        new = np.ones(len(some), bool)
        new[1:] = (some[1:] != some[:-1]) | (doc[1:] != doc[:-1])
        count = np.bincount(doc[new], minlength=len(at) - 1)
        number = np.cumsum(new) - 1
        begins = np.cumsum(count) - count
        yield hashes[is_word], doc + done, number - begins[doc], count, [codes, first[is_word], end[is_word]]
        done += len(at) - 1


def _word_counts(labels, n_subjects: int):
    """Per task: of each word the documents with it, and those with it among the labelled ones of each subject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = labels.value
        total, docs = pd.DataFrame(), 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            docs += len(ids)
            bits = np.array([known.get(i, 0) for i in ids], np.int64)
            parts = []
            for hashes, doc, _, _, (codes, first, end) in _sentences(batch.column("text").to_pylist()):
                if not len(hashes):
                    continue
                terms, at, code = np.unique(hashes, return_index=True, return_inverse=True)
                pair = np.unique(doc * len(terms) + code)
                d, w = pair // len(terms), pair % len(terms)
                words = ["".join(map(chr, codes[first[i] : end[i]])) for i in at]
                columns = {"term": terms.view(np.int64), "word": words, "df": np.bincount(w, minlength=len(terms))}
                for k in range(n_subjects):
                    columns[f"c{k}"] = np.bincount(w[(bits[d] >> k) & 1 > 0], minlength=len(terms))
                columns["labelled"] = np.bincount(w[bits[d] > 0], minlength=len(terms))
                parts.append(pd.DataFrame(columns))
            if parts:
                total = pd.concat([total, *parts]).groupby("term", as_index=False).agg({"word": "first"} | dict.fromkeys(["df", *(f"c{k}" for k in range(n_subjects)), "labelled"], "sum"))
        if docs:  # a row without word has the number of documents
            total = pd.concat([total, pd.DataFrame({"term": [0], "word": [None], "df": [docs]} | {c: [0] for c in [*(f"c{k}" for k in range(n_subjects)), "labelled"]})])
            yield pa.RecordBatch.from_pandas(total.astype({"word": "string"}), preserve_index=False)

    return run


def _corpus(vocabulary, rest: int, parts: int):
    """Per document its terms with their sentences, and its number of sentences. A word outside of the vocabulary is one of ``rest`` further terms, by hash;
    number -1 marks a term that says nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, number, others = vocabulary.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            counts, packed, places = [], [], []
            for hashes, doc, sentence, count, _ in _sentences(batch.column("text").to_pylist()):
                at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
                good = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
                w = others[(hashes % np.uint64(rest)).astype(np.int64)]
                w[good] = number[at[good]]
                w, s, d = w[w >= 0], sentence[w >= 0], doc[w >= 0]
                base = len(counts)
                cuts = np.searchsorted(d, np.arange(base, base + len(count) + 1))
                counts += count.tolist()
                for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    packed.append(w[i:j].astype(np.uint16).tobytes())
                    places.append(s[i:j].astype(np.uint32).tobytes())
            part = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
            counts = counts + [0] * (batch.num_rows - len(counts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(packed, pa.binary()), pa.array(places, pa.binary()), pa.array(part.astype(np.int32))], names=["doc_id", "sentences", "terms", "places", "part"])

    return run


def digamma(x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    x = x.copy()
    for _ in range(6):
        low = x < 6
        out -= np.where(low, 1 / x, 0)
        x += low
    i = 1 / x
    return out + np.log(x) - 0.5 * i - i * i * (1 / 12 - i * i / 120)


def _expected(topics: np.ndarray) -> np.ndarray:
    return np.exp(digamma(topics) - digamma(topics.sum(1, keepdims=True)))


def infer(term_weight: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, alpha: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of n documents and the expected topic counts of each (document, term), which are sorted by document."""
    k = term_weight.shape[1]
    gamma = np.ones((n, k), np.float32)
    if not len(doc):
        return np.full((n, k), alpha, np.float32), np.zeros((0, k), np.float32)
    starts = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
    weight = term_weight[term]
    for _ in range(steps):
        mean = np.exp(digamma(gamma) - digamma(gamma.sum(1, keepdims=True)))
        share = weight * mean[doc]
        share *= (count / np.maximum(share.sum(1), 1e-30)).astype(np.float32)[:, None]
        gamma = np.full((n, k), alpha, np.float32)
        gamma[doc[starts]] += np.add.reduceat(share, starts, axis=0)
    return gamma, share


def _unpacked(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    lists = [np.frombuffer(x, np.uint16) for x in batch.column("terms").to_pylist()]
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    term = np.concatenate([np.zeros(0, np.uint16), *lists]).astype(np.int64)
    code, count = np.unique(doc * size + term, return_counts=True)
    return doc, term, code // size, code % size, count


def _gather(topics, alpha: float, steps: int, slices: int):
    """Expected term counts of a task's documents, in slices of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lam = topics.value
        k, v = lam.shape
        weight, total = np.ascontiguousarray(_expected(lam).T.astype(np.float32)), np.zeros((k, v))
        for batch in batches:
            _, _, doc, term, count = _unpacked(batch, v)
            _, share = infer(weight, doc, term, count, batch.num_rows, alpha, steps)
            for i in range(k):
                total[i] += np.bincount(term, weights=share[:, i], minlength=v)
        from pyspark import TaskContext

        pieces = np.array_split(total.astype(np.float32), slices, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([TaskContext.get().partitionId()] * slices, pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())], names=["slice", "task", "sums"])

    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in rows["sums"])
    return pd.DataFrame({"slice": rows["slice"].iloc[:1], "task": rows["task"].iloc[:1], "sums": [total.astype(np.float32).tobytes()]})


def _decide(model, alpha: float, steps: int, least: float = 0.02):
    """Per document and subject the subject's topics' part of the document's topic proportions: the mean over its sentences of the
    probability of these topics, given the sentence's terms and the document's proportions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lam, subject_of = model.value
        k, v = lam.shape
        membership = (subject_of[:, None] == np.arange(max(int(subject_of.max(initial=-1)) + 1, 1))).astype(np.float32)
        weight = np.ascontiguousarray(_expected(lam).T.astype(np.float32))
        logs = np.ascontiguousarray(np.log((lam + 0.01) / (lam + 0.01).sum(1, keepdims=True)).T.astype(np.float32))
        for batch in batches:
            every, term, doc, own, count = _unpacked(batch, v)
            if not len(every):
                continue
            gamma, _ = infer(weight, doc, own, count, batch.num_rows, alpha, steps)
            theta = np.log(gamma / gamma.sum(1, keepdims=True) + 1e-6)
            place = np.concatenate([np.frombuffer(x, np.uint32) for x in batch.column("places").to_pylist()]).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, (np.diff(every) != 0) | (np.diff(place) != 0)])
            score = np.add.reduceat(logs[term], starts, axis=0) + theta[every[starts]]
            p = np.exp(score - score.max(1, keepdims=True))
            p = (p / p.sum(1, keepdims=True)) @ membership
            docs = every[starts]
            begins = np.flatnonzero(np.r_[True, np.diff(docs) > 0])
            share = np.zeros((batch.num_rows, membership.shape[1]))
            share[docs[begins]] = np.add.reduceat(p, begins, axis=0)
            share /= np.maximum(batch.column("sentences").to_numpy(), 1)[:, None]
            i, s = np.nonzero(share >= least)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(i)), pa.array(s.astype(np.int32)), pa.array(share[i, s])], names=["doc_id", "number", "share"])

    return run


@dataclass
class Model:
    """Fitted topics: topics (topic x term), words, the subject number of each topic (-1: none) and the names of the subjects."""

    topics: np.ndarray
    words: list[str]
    subject_of: np.ndarray
    names: list[str]

    def top_terms(self, n: int = 15) -> list[tuple[int, str, list[str]]]:
        """For inspection: topic, subject, and the terms of the largest weight."""
        return [(k, self.names[s] if s >= 0 else "", [self.words[i] for i in np.argsort(-self.topics[k])[:n]]) for k, s in enumerate(self.subject_of)]


class SubjectModel:
    """Settings and the fit. ``label_rows`` bounds the labelled documents used, one in ``hold`` of which only serves to find the share from which on a subject is
    given. The ``vocabulary`` terms in most documents are terms of their own, all other words share ``rest`` terms by hash (65,536 in all at most); ``free`` is the number of topics
    without a subject at the start; ``epochs`` times ``parts`` updates are made, each over one part of all documents."""

    def __init__(self, label_rows: int = 50_000, hold: int = 5, vocabulary: int = 20_000, rest: int = 4_096, free: int = 4, parts: int = 4, epochs: int = 1, steps: int = 8, alpha: float = 0.1, seed: int = 0):
        if vocabulary + rest > 65_536:
            raise ValueError("more than 65,536 terms")
        self.label_rows, self.hold, self.vocabulary, self.rest = label_rows, hold, vocabulary, rest
        self.free, self.parts, self.epochs, self.steps, self.alpha, self.seed = free, parts, epochs, steps, alpha, seed

    def labelled(self, labels: DataFrame, names: list[str]) -> tuple[dict[int, int], dict[int, int]]:
        """Subjects of labelled documents as bits: those to learn from, and those held out."""
        spark = labels.sparkSession
        key = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "_")
        numbered = spark.createDataFrame([(x.strip().lower().replace(" ", "_").replace("-", "_"), 1 << i) for i, x in enumerate(names)], "subject string, bit long")
        bits = labels.filter("doc_id is not null").select("doc_id", key(F.col("subject")).alias("subject")).join(F.broadcast(numbered), "subject").groupBy("doc_id").agg(F.bit_or("bit").alias("bits"))
        rows = bits.orderBy(F.xxhash64("doc_id"), "doc_id").limit(self.label_rows).select("doc_id", "bits", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(self.hold)) == 0).alias("held")).collect()
        return {r["doc_id"]: r["bits"] for r in rows if not r["held"]}, {r["doc_id"]: r["bits"] for r in rows if r["held"]}

    def fit(self, docs: DataFrame, known: dict[int, int], subjects: DataFrame) -> tuple[Model, DataFrame, Shelf]:
        """The model, the documents as term lists for :meth:`shares`, and the shelf that these lie on."""
        spark = docs.sparkSession
        broadcast = spark.sparkContext.broadcast
        rows = subjects.filter("subject is not null").select("subject", "description").distinct().orderBy("subject").limit(10_000).collect()
        names = list(dict.fromkeys(r["subject"] for r in rows))
        n = len(names)
        own = docs.filter("doc_id is not null and length(text) > 0").select("doc_id", "text")
        counts = ["df", *(f"c{k}" for k in range(n)), "labelled"]
        counted = own.mapInArrow(_word_counts(broadcast(known), n), f"term long, word string, {', '.join(f'{c} long' for c in counts)}")
        counted = cut(counted.groupBy("term", F.col("word").isNull().alias("total")).agg(F.max("word").alias("word"), *(F.sum(c).alias(c) for c in counts)))
        total = counted.filter("total").agg(F.sum("df")).first()[0] or 0
        words_ = counted.filter("not total")
        found = words_.orderBy(F.desc("df"), "term").limit(self.vocabulary).toPandas()
        last = found.iloc[-1] if len(found) else None
        beyond = words_.filter((F.col("df") < int(last["df"])) | ((F.col("df") == int(last["df"])) & (F.col("term") > int(last["term"])))) if len(found) else words_
        # The hash as an unsigned number, as in _corpus: 2 ** 64 more than a negative one.
        slot = F.pmod(F.pmod("term", F.lit(self.rest)) + F.when(F.col("term") < 0, (1 << 64) % self.rest).otherwise(0), F.lit(self.rest)).cast("int")
        shared = beyond.groupBy(slot.alias("slot")).agg(*(F.sum(c).alias(c) for c in counts)).toPandas()
        every = pd.concat([found, shared.assign(word=[f"other {i}" for i in shared["slot"]])], ignore_index=True)
        stats = every[[f"c{k}" for k in range(n)]].to_numpy(np.float64).T
        labelled = every["labelled"].to_numpy(np.float64)
        words = every["word"].tolist()
        size = np.array([sum(b >> k & 1 for b in known.values()) for k in range(n)], np.float64)
        n_known = len(known)
        for k, x in enumerate(names):  # a description counts as three more labelled documents
            told = {w for r in rows if r["subject"] == x for w in (r["description"] or "").lower().replace(",", " ").split()}
            at = np.array([w in told for w in words], bool)
            stats[k][at] += 3
            labelled[at] += 3
        size, n_known = size + 3, n_known + 3 * n
        expected = labelled[None, :] * (size / max(n_known, 1))[:, None]
        lift = np.log((stats + 0.5) / (size[:, None] + 1) / ((labelled + 0.5) / (n_known + 1))[None, :]) if n else np.zeros((0, len(words)))
        score = (stats - expected) / np.sqrt(expected + 0.5)
        telling = ((score >= 3) & (lift >= 0.5)).any(0) if n else np.zeros(len(words), bool)
        keep = telling | (labelled < 8)  # terms that occur evenly in documents of all subjects say nothing
        number = np.where(keep, np.cumsum(keep) - 1, -1).astype(np.int64)
        terms = found["term"].to_numpy(np.int64).view(np.uint64) if len(found) else np.zeros(0, np.uint64)
        order = np.argsort(terms)
        others = np.full(self.rest, -1, np.int64)
        others[shared["slot"].to_numpy(np.int64)] = number[len(found) :]
        words = [w for w, k in zip(words, keep) if k]
        stats, lift, score, df = stats[:, keep], lift[:, keep], score[:, keep], every["df"].to_numpy(np.float64)[keep]
        shelf = Shelf(spark, "subjects")
        corpus = shelf.put("corpus", own.mapInArrow(_corpus(broadcast((terms[order], number[: len(found)][order], others)), self.rest, self.parts), "doc_id long, sentences int, terms binary, places binary, part int"), ("part",))
        rng = np.random.default_rng(self.seed)
        lam = np.full((n + self.free, len(words)), 0.01)
        grow = 0.25 * total / max(n_known, 1)
        lam[:n] += np.where((lift > 0.5) & (score >= 2), stats * np.maximum(lift, 0), 0) * grow
        if len(words):
            lam[n:] += df / df.sum() * 0.2 * total * rng.gamma(5, 0.2, (self.free, len(words)))
        for step in range(self.epochs * self.parts if len(words) else 0):
            sums = self._sums(corpus.filter(F.col("part") == step % self.parts), broadcast(lam))
            pieces = [np.frombuffer(bytes(r["sums"]), np.float32).reshape(len(lam), -1) for r in sums]
            if pieces:
                rate = (step + 2) ** -0.5
                lam = (1 - rate) * lam + rate * (0.01 + self.parts * np.concatenate(pieces, axis=1))
        most = np.log((n_known + 1) / (size + 1))
        return Model(lam, words, self._subjects(lam, lift, most), names), corpus, shelf

    def _sums(self, part: DataFrame, topics, fan_in: int = 32) -> list:
        """Expected term counts over a part of the corpus, added up in rounds of at most ``fan_in`` tasks."""
        schema = "slice int, task int, sums binary"
        tasks, sums = part.rdd.getNumPartitions(), part.mapInArrow(_gather(topics, self.alpha, self.steps, 8), schema)
        while tasks > fan_in:
            tasks = -(-tasks // fan_in)
            sums = sums.groupBy("slice", F.floor(F.col("task") / fan_in).cast("int").alias("__task")).applyInPandas(_add, schema).withColumn("task", F.floor(F.col("task") / fan_in).cast("int"))
        return sorted(sums.groupBy("slice").applyInPandas(_add, schema).collect(), key=lambda r: r["slice"])

    def _subjects(self, lam: np.ndarray, lift: np.ndarray, most: np.ndarray, top: int = 30) -> np.ndarray:
        """The subject of each topic: that of which its top terms are most typical, if they are at least half as typical
        (on a logarithmic scale) as terms that no other subject has."""
        out = np.full(len(lam), -1)
        if not lift.size:
            return out
        for k, row in enumerate(lam):
            best = np.argsort(-row)[:top]
            weight = row[best] / row[best].sum()
            typical = (np.clip(lift[:, best], 0, None) * weight).sum(1)
            if typical.max() >= 0.5 * most[typical.argmax()] and row.sum() > 1:
                out[k] = int(typical.argmax())
        return out

    def shares(self, model: Model, corpus: DataFrame) -> DataFrame:
        """doc_id, number of the subject and its share of the document."""
        spark = corpus.sparkSession
        if not model.words or (model.subject_of < 0).all():
            return spark.createDataFrame([], "doc_id long, number int, share double")
        return corpus.mapInArrow(_decide(spark.sparkContext.broadcast((model.topics, model.subject_of)), self.alpha, self.steps), "doc_id long, number int, share double")


def best_share(shares: DataFrame, held: dict[int, int], default: float = 0.2, least: int = 30) -> float:
    """The share from which on a subject is given: that with the best agreement (F1) with the held-out labels; of equally good ones (within half a percent) the
    middle. The default, if there are fewer labels than ``least``. The labels are bounded by the parameter of the model."""
    spark = shares.sparkSession
    if sum(b.bit_count() for b in held.values()) < least:
        return default
    some = spark.createDataFrame(list(held.items()), "doc_id long, bits long")
    rows = shares.join(some, "doc_id").filter("share >= 0.05").select("share", ((F.shiftright("bits", 0).bitwiseAND(F.expr("shiftleft(1L, number)"))) != 0).alias("true")).toPandas()
    tried = np.arange(0.08, 0.40, 0.005)
    total = sum(b.bit_count() for b in held.values())
    share, true = rows["share"].to_numpy(float), rows["true"].to_numpy(bool)
    f1 = np.array([2 * (true & (share >= t)).sum() / max(total + (share >= t).sum(), 1) for t in tried])
    return float(np.median(tried[f1 >= f1.max() - 0.005]))


def assign(docs: DataFrame, labels: DataFrame, subjects: DataFrame, share: float | None = None, **settings) -> DataFrame:
    """doc_id, subject, share: each subject that at least ``share`` of a document is about (by default what :func:`best_share` finds on held-out labels, as some
    sentences of a subject can't be told).

    Documents without doc_id or
    text get no row; labels of unknown subjects or documents are ignored, repeated ones count once; without labels the
    descriptions of the subjects serve alone. More than 63 subjects are an error.
    """
    spark, own = docs.sparkSession, SubjectModel(**settings)
    names = sorted(r["subject"] for r in subjects.filter("subject is not null").select("subject").distinct().limit(64).collect())
    if len(names) > 63:
        raise ValueError("more than 63 subjects")
    known, held = own.labelled(labels, names)
    model, corpus, shelf = own.fit(docs, known, subjects)
    shares = cut(own.shares(model, corpus))
    shelf.drop()
    named = spark.createDataFrame(list(enumerate(model.names)), "number int, subject string")
    given = share if share is not None else best_share(shares, held)
    return shares.filter(F.col("share") >= given).join(F.broadcast(named), "number").select("doc_id", "subject", "share")
