"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents, a field needs labelled tokens. Tokens are labelled first:
a word, or a word beginning of four letters or more, that several toxic documents
of the sample have and clean ones do not, marks the tokens it is in. The field
then learns from words, beginnings, ends and neighbours, so that it also finds
forms the sample lacks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm import chain
from hackney.llm.frames import kind_of, map_slices, pick, texts_of

TOKEN = re.compile(r"\w+")
# Labelled documents of each class that the fit takes; whole texts are read.
SAMPLE = 1500
# A cue is in this share of the sampled toxic documents, and in no more than that share of clean ones.
CUE_SHARE, CLEAN_SHARE = 0.02, 0.001
# How many cues of a sample may be cues by chance.
CHANCE = 0.05
# Tokens of a training window, and windows without a cue that a document gives.
WINDOW, PLAIN_WINDOWS = 48, 2
EPOCHS = 5
# Marginals below this add nothing to a document's score; numbers that a score is made of; ridge of its weights.
FAINT, SIGNS, RIDGE = 0.05, 5, 0.01
# Share of training tokens of which only the beginning is shown, so that it is learnt for itself.
HIDDEN = 0.3
# Scores of that many distinct words are remembered in a Python worker.
REMEMBERED = 1 << 17


def beginnings(word: str) -> list[str]:
    return [word[:k] for k in (4, 5, 6) if len(word) > k]


def token_features(word: str, hidden: bool = False) -> list[int]:
    """Features of a word; of a hidden one, only what its beginning shows."""
    parts = ["bias", f"n={min(len(word), 12)}", *(f"b{k}={word[:k]}" for k in (3, 4, 5, 6) if len(word) > k)]
    if not hidden:
        parts += [f"w={word}", *(f"e{k}={word[-k:]}" for k in (3, 4) if len(word) > k)]
    return [chain.feature(p) for p in parts]


def _distinct(texts: Iterable[list[str]]) -> list[list[str]]:
    """Texts less near copies, so that what one text says is not counted for each of its copies."""
    kept, seen = [], set()
    for words in texts:
        shingles = {" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))}
        marks = {(seed, min(crc32(s, seed) for s in shingles)) for seed in (1, 2, 3, 4)}
        if not marks & seen:
            kept.append(words)
        seen |= marks
    return kept


def cues(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Words, and beginnings written with a hyphen, that tell toxic documents from clean ones.

    A cue is in so many toxic documents and so few clean ones that no cue of the sample is
    likely to be so by chance. Documents that a cue explains are set aside and the rest is
    searched again, so that what marks a few documents of one language is found as well.
    """

    def held(words: list[str]) -> set[str]:
        distinct = set(words)
        return distinct | {b + "-" for w in distinct for b in beginnings(w)}

    good = Counter(cue for words in clean for cue in held(words))
    rest, found = [held(words) for words in toxic], set()
    while rest:
        bad = Counter(cue for cues_in in rest for cue in cues_in)
        share = len(rest) / (len(rest) + len(clean))
        by_chance = math.log(len(bad) / CHANCE) / -math.log(share) if clean else math.inf
        least = max(CUE_SHARE * len(rest), by_chance)
        new = {cue for cue, n in bad.items() if n >= least and good[cue] <= CLEAN_SHARE * len(clean)}
        if not new:
            break
        found |= new
        rest = [cues_in for cues_in in rest if not cues_in & new]
    return found


def label_tokens(words: list[str], marked: set[str]) -> np.ndarray:
    return np.array([w in marked or any(b + "-" in marked for b in beginnings(w)) for w in words], np.int64)


def _field(toxic: list[list[str]], clean: list[list[str]], seed: int) -> chain.Chain | None:
    """A field from words of toxic and clean documents; None if no cue tells them apart."""
    marked = cues(toxic, clean)
    if not marked or not clean:
        return None
    pick_some = np.random.default_rng(seed)
    sequences, tags = [], []
    for words in [*toxic, *clean]:
        labels = label_tokens(words, marked)
        starts = range(0, len(words), WINDOW)
        plain = [s for s in starts if not labels[s : s + WINDOW].any()]
        chosen = set(pick_some.choice(plain, min(len(plain), PLAIN_WINDOWS), replace=False)) if plain else set()
        for s in starts:
            if s in chosen or labels[s : s + WINDOW].any():
                window = words[s : s + WINDOW]
                hidden = pick_some.random(len(window)) < HIDDEN
                features = [token_features(w, h) for w, h in zip(window, hidden, strict=True)]
                wide = max(map(len, features))
                sequences.append(np.array([f + [0] * (wide - len(f)) for f in features]))
                tags.append(labels[s : s + WINDOW])
    return chain.fit(sequences, tags, epochs=EPOCHS, seed=seed)


def _logistic(rows: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, held near zero by a small ridge; a row counts `counts` times."""
    weights = np.zeros(rows.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (counts * (labels - chance)) - RIDGE * weights
        curve = (rows * (counts * chance * (1 - chance))[:, None]).T @ rows + RIDGE * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def fit(rows: Iterable[tuple[str, int]], totals: Sequence[int], seed: int = 7) -> Tagger | None:
    """A tagger from (text, label) rows; None without labels of both kinds or without any cue.

    totals: how many clean and how many toxic documents are labelled in all. The sample has as many of either
    as it can; in the document score each kind weighs as much as it has documents.

    How marginals make a document's score is learnt on documents that the field has not seen: each half of
    the sample is tagged by a field of the other half. The field that is kept learns from all.
    """
    texts: dict[int, dict[str, None]] = {0: {}, 1: {}}
    for text, label in rows:
        texts[int(label)][text or ""] = None
    toxic, clean = (_distinct([TOKEN.findall(t.lower()) for t in texts[label]]) for label in (1, 0))
    whole = _field(toxic, clean, seed)
    if whole is None:
        return None
    signs, labels = [], []
    for half in (0, 1):
        other = _field(toxic[1 - half :: 2], clean[1 - half :: 2], seed) or whole
        tagger = Tagger(other, np.zeros(SIGNS))
        for label, documents in ((1, toxic[half::2]), (0, clean[half::2])):
            signs += [sign for sign, _ in tagger.signs([" ".join(words) for words in documents])]
            labels += [label] * len(documents)
    known = np.array(labels)
    counts = np.where(known == 1, totals[1] / max(1, known.sum()), totals[0] / max(1, (1 - known).sum()))
    return Tagger(whole, _logistic(np.array(signs), known.astype(float), counts / counts.mean()))


class Tagger:
    """A fitted field and a document score over it; what a word adds is remembered."""

    def __init__(self, model: chain.Chain, score: np.ndarray):
        used = np.flatnonzero(np.any(model.weights != 0, axis=1))
        self.places, self.values = used, model.weights[used, 1] - model.weights[used, 0]
        self.start, self.moves, self.score = model.start, model.moves, score

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("places", "values", "start", "moves", "score")}

    def __getattr__(self, name: str):
        if name == "table":
            self.table = np.zeros(chain.WIDTH)
            self.table[self.places] = self.values
        elif name == "lead":
            self.lead = lru_cache(REMEMBERED)(lambda word: float(self.table[token_features(word.lower())].sum()))
        else:
            raise AttributeError(name)
        return self.__dict__[name]

    def signs(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: what its score is made of, and the marginals of its tokens.

        The first holds 1, the expected number of different toxic words (the first, the second and the logarithm
        of the rest, each for itself), and the logarithm of the number of tokens: one odd word in a long text
        tells less than several in a short one.
        """
        words = [TOKEN.findall(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        leads = np.fromiter((x for w in words for x in map(self.lead, w)), float, sizes.sum())
        begins = np.zeros(len(leads), bool)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        begins[offsets[:-1][sizes > 0]] = True
        chances = chain.pair_marginals(chain.Chain(np.zeros((0, 2)), self.start, self.moves), leads, begins)
        found = []
        for own_words, a, b in zip(words, offsets[:-1], offsets[1:]):
            own = chances[a:b]
            likely: dict[str, float] = {}
            for i in np.flatnonzero(own >= FAINT).tolist():
                word = own_words[i].lower()
                likely[word] = max(likely.get(word, 0.0), float(own[i]))
            s = sum(likely.values())
            parts = [min(s, 1.0), min(max(s - 1.0, 0.0), 1.0), math.log1p(max(s - 2.0, 0.0))]
            found.append((np.array([1.0, *parts, math.log1p(b - a)]), own))
        return found

    def tag(self, texts: list[str]) -> list[tuple[float, list[dict[str, int]]]]:
        """Per text: its score, and offsets of runs of tokens that are likelier toxic than not."""
        found = []
        for text, (signs, own) in zip(texts, self.signs(texts), strict=True):
            spans: list[dict[str, int]] = []
            if len(own) and own.max() >= 0.5:
                last = -2
                for i, match in enumerate(TOKEN.finditer(text)):
                    if own[i] >= 0.5:
                        if last == i - 1:
                            spans[-1]["end"] = match.end()
                        else:
                            spans.append({"start": match.start(), "end": match.end()})
                        last = i
            chance = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(signs @ self.score)))))
            found.append((chance if len(own) else 0.0, spans))
        return found


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    """Fit on up to `sample` labelled documents of each class, taken in the order of a hash of their ids.

    Every fifth document by the checksum of its id is held out. Only the chosen ids, 2 * sample
    at most, are broadcast, and only their texts reach the driver.
    """
    known = pick(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(sample).unionAll(known.where("toxic = 0").orderBy(*order).limit(sample))
    texts = texts_of(documents).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in texts.toLocalIterator())
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    return fit(((text, label) for _, text, label in rows), (totals.get(0, 0), totals.get(1, 0)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Toxicity of each whole text: doc_id, score (0 to 1), spans array<struct<start, end>> in code points.

    Spans are single tokens or runs of them that are likelier toxic than not; the score weighs how many
    different ones there are, so a document below 0.5 may have a span. One row per row of `documents`; repeated rows score alike, a null or empty text scores 0
    with no spans, a null doc_id stays null and is never learnt from. Labels other than 0 and 1
    are left out; where a document has several, toxic wins. Without labels of both kinds, or
    without any word that tells them apart, all score 0. Scores depend on texts alone. Other
    columns are ignored; an empty table gives an empty table.
    """
    rows = texts_of(documents)
    tagger = learn(documents, labels, sample)
    kind = kind_of(rows, "doc_id")
    if tagger is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.expr("cast(array() as array<struct<start bigint, end bigint>>) AS spans"))
    shared = documents.sparkSession.sparkContext.broadcast(tagger)
    item = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def tagged(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.tag(batch.column("text").to_pylist())
        scores, spans = pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.list_(item))
        return pa.record_batch([batch.column("doc_id"), scores, spans], ["doc_id", "score", "spans"])

    return map_slices(rows, tagged, f"doc_id {kind}, score double, spans array<struct<start bigint, end bigint>>")


def drop_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that score below 0.5, all columns as they were, whatever they are called.

    Scores are taken beside the rows in the same task, so nothing is shuffled. Cases as in `score`.
    """
    tagger = learn(documents, labels, sample)
    if tagger is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(tagger)
    at = documents.columns.index("text")

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(at).to_pylist()]
        return batch.filter(pa.array([s < 0.5 for s, _ in shared.value.tag(texts)], pa.bool_()))

    plain = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    return map_slices(plain, kept, plain.schema).toDF(*documents.columns)
