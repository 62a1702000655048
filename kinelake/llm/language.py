"""Languages of documents and their segments by a string kernel.

Sentences are compared by how many distinct n-grams of one to four characters
they share (a blended-spectrum presence kernel, normalized). Nystroem landmarks
turn the kernel into features, one-versus-rest kernel ridge regression on them
gives a score per language, and a Viterbi pass over a document's sentences gives
its segments. The kernel is linear in the n-grams, so the landmarks' part is
multiplied out once: scoring is a sparse presence matrix times a weight matrix.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.session import spread

LANGUAGES = ["de", "en", "es", "fr", "pt", "zh"]
#: Three-letter codes and English names of the languages.
SPELLINGS = {
    "deu": "de", "ger": "de", "german": "de", "eng": "en", "english": "en", "spa": "es", "spanish": "es",
    "fra": "fr", "fre": "fr", "french": "fr", "por": "pt", "portuguese": "pt", "zho": "zh", "chi": "zh", "chinese": "zh",
}
#: Labels that say nothing.
MISSING = ["", "und", "unknown", "n/a"]
#: Bounds of the training sample: labelled documents per language, sentences, landmarks.
TRAIN_DOCUMENTS, TRAIN_SENTENCES, LANDMARKS = 300, 6000, 480
GRAMS, TABLE_BITS = 4, 22
RIDGE, SHARPNESS, SWITCH = 1e-2, 6.0, 2.0
SEGMENT = "doc_id bigint, lang string, segment_no int, language string, confidence double, start int, stop int, segments int"
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

END = re.compile(r"[.!?]+[\"'”»)\]]*(?=\s|$)|[。！？]+[\"'”»)\]]*")
QUOTED = re.compile(r"\"[^\"\n]{0,80}\"|“[^”\n]{0,80}”|«[^»\n]{0,80}»|„[^“”\n]{0,80}[“”]|\[[^\]\n]{0,80}\]|\([^)\n]{0,80}\)")
IDENTIFIER = re.compile(r"[^\s。，！？、；：㐀-鿿]*[0-9_#=/\\@][^\s。，！？、；：㐀-鿿]*")
OPENING, MARK = re.compile(r"[\"“«„\[(]"), re.compile(r"[0-9_#=/\\@]")
HAN = re.compile(r"[㐀-鿿]")
WORD = re.compile(r"[^\W\d_]+")


def label_key(lang: Column) -> Column:
    """A label's language code: null if it says nothing, its first part in lower case otherwise."""
    flat = F.lower(F.regexp_replace(lang, r"(?U)^\s+|\s+$", ""))
    head = F.regexp_extract(flat, r"^([^-_]*)", 1)
    known = F.create_map(*[F.lit(x) for kv in SPELLINGS.items() for x in kv])
    return F.when(~flat.isin(*MISSING), F.coalesce(F.try_element_at(known, head), head))


def sentences(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, stop, plain text, whether it counts) of each sentence or other unit, in order.

    Plain text is without quotations, brackets and identifiers, in lower case. A
    unit counts if enough words are left; headings and numbers do not.
    """
    out = []
    at = 0
    for line in text.split("\n"):
        begin = at
        at += len(line) + 1
        cuts = [m.end() for m in END.finditer(line)]
        if not cuts or cuts[-1] < len(line):
            cuts.append(len(line))
        s = 0
        for e in cuts:
            raw = line[s:e]
            if raw.strip():
                bare = QUOTED.sub(" ", raw) if OPENING.search(raw) else raw
                plain = " ".join((IDENTIFIER.sub(" ", bare) if MARK.search(bare) else bare).lower().split())
                words = WORD.findall(plain)
                han = 0 if plain.isascii() else len(HAN.findall(plain))
                if han:
                    words = [w for w in words if not HAN.match(w)]
                counts = han >= 3 or (len(words) >= 2 and sum(map(len, words)) >= 8 and (len(words) >= 5 or END.search(raw[-4:]) is not None))
                out.append((begin + s, begin + e, plain, counts))
            s = e
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every distinct n-gram of every text."""
    joined = "".join(f" {t} \x00" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.cumsum(codes == 0) - (codes == 0)
    inside = codes != 0
    keys, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    run = inside.copy()
    for n in range(1, GRAMS + 1):
        if n > 1:
            run = run[:-1] & inside[n - 1 :]
            h = h[:-1]
        h = (h ^ (codes[n - 1 :] + np.uint64(n))) * MULTIPLIERS[n - 1]
        h ^= h >> np.uint64(29)
        keys.append(h[run])
        owners.append(owner[: len(run)][run])
    return np.concatenate(owners), np.concatenate(keys)


class KernelModel:
    """Presence-kernel ridge regression multiplied out to a weight per n-gram and language."""

    def __init__(self, texts: list[str], labels: list[int], classes: int, landmarks: int = LANDMARKS, seed: int = 5):
        labels_ = np.asarray(labels)
        rng = np.random.default_rng(seed)
        picks = []
        for c in range(classes):
            own = np.flatnonzero(labels_ == c)
            if len(own):
                picks.append(rng.choice(own, min(len(own), landmarks // classes), replace=False))
        marks = np.sort(np.concatenate(picks))
        o, k = grams([texts[i] for i in marks])
        self._index(np.unique(k))
        m = self._matrix(o, k, len(marks))  # landmarks x n-grams
        norm = np.sqrt(np.maximum(m.sum(1), 1))
        m /= norm[:, None]
        gram = m @ m.T
        value, vector = np.linalg.eigh(gram + 1e-6 * np.eye(len(marks)))
        root = vector / np.sqrt(np.maximum(value, 1e-9)) @ vector.T
        feats = np.concatenate([self._kernel(texts[a : a + 2000], m) for a in range(0, len(texts), 2000)]) @ root
        y = -np.ones((len(texts), classes))
        y[np.arange(len(texts)), labels_] = 1
        weight = np.bincount(labels_, minlength=classes).astype(float)
        w = np.sqrt(len(texts) / np.maximum(classes * weight[labels_], 1))[:, None]  # languages count alike
        f = np.concatenate([feats, np.ones((len(feats), 1))], 1) * w
        ridge = RIDGE * len(texts) / 100 * np.eye(f.shape[1])
        beta = np.linalg.solve(f.T @ f + ridge, f.T @ (y * w))
        self.bias = beta[-1].astype(np.float32)
        self.weights = (m.T @ (root @ beta[:-1])).astype(np.float32)

    def _index(self, vocabulary: np.ndarray) -> None:
        """A direct table for the n-grams; those of one place follow one another in a chain."""
        self.vocabulary = vocabulary
        self.table = np.full(1 << TABLE_BITS, -1, np.int32)
        self.following = np.full(len(vocabulary), -1, np.int32)
        slot = self._slot(vocabulary)
        for i in np.argsort(slot, kind="stable")[::-1].tolist():
            self.following[i] = self.table[slot[i]]
            self.table[slot[i]] = i

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * MULTIPLIERS[0]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def presence(self, owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, n-gram number) pairs of the vocabulary, sorted."""
        at = self.table[self._slot(keys)]
        ok = at >= 0
        at, owner, keys = at[ok].astype(np.int64), owner[ok], keys[ok]
        other = np.flatnonzero(self.vocabulary[at] != keys)
        while len(other):  # further along the chain of their place, where it goes on
            at[other] = self.following[at[other]]
            other = other[at[other] >= 0]
            other = other[self.vocabulary[at[other]] != keys[other]]
        ok = at >= 0
        kind = np.int32 if len(self.vocabulary) * (int(owner.max(initial=0)) + 1) < 2**31 else np.int64
        pair = np.sort(owner[ok].astype(kind) * kind(len(self.vocabulary)) + at[ok].astype(kind))
        first = np.ones(len(pair), bool)
        first[1:] = pair[1:] != pair[:-1]
        pair = pair[first]
        return pair // len(self.vocabulary), pair % len(self.vocabulary)

    def _matrix(self, owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
        r, c = self.presence(owner, keys)
        out = np.zeros((n, len(self.vocabulary)), np.float32)
        out[r, c] = 1
        return out

    def _kernel(self, texts: list[str], marks: np.ndarray) -> np.ndarray:
        return self._multiply(texts, np.ascontiguousarray(marks.T))

    def _multiply(self, texts: list[str], dense: np.ndarray) -> np.ndarray:
        """The normalized presence matrix of the texts times ``dense``."""
        out = np.zeros((len(texts), dense.shape[1]), np.float32)
        wide = dense.shape[1] > 32
        step = max(1, (20_000_000 // len(self.vocabulary)) if wide else 40_000_000 // (300 * dense.shape[1]))
        for a in range(0, len(texts), step):
            part = texts[a : a + step]
            if wide:
                m = self._matrix(*grams(part), len(part))
                out[a : a + step] = (m / np.sqrt(np.maximum(m.sum(1), 1))[:, None]) @ dense
                continue
            r, c = self.presence(*grams(part))
            if len(r):
                start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                size = np.diff(np.append(start, len(r)))
                out[a + r[start]] = np.add.reduceat(dense[c], start, axis=0) / np.sqrt(size)[:, None]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return self._multiply(texts, self.weights) + self.bias


def train(documents: DataFrame, seed: int = 5, per_language: int = TRAIN_DOCUMENTS, most_sentences: int = TRAIN_SENTENCES) -> KernelModel | None:
    """Fit on a bounded sample of labelled documents, without sentences that a fit to the other folds puts elsewhere.

    The sample takes, per language, about ``per_language`` documents by a hash of
    the doc_id, and of their sentences at most ``most_sentences``, spread evenly.
    None if fewer than two languages are labelled.
    """
    labelled = documents.select("doc_id", "text", label_key(F.col("lang")).alias("label")).where(F.col("label").isin(*LANGUAGES) & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.1 * per_language / n))])
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_003)) / 1_000_003
    sample = labelled.where(place < share[F.col("label")]).limit(2 * per_language * len(LANGUAGES)).collect()  # bounded by the parameter
    by_label: dict[str, list[str]] = {}
    for r in sorted(sample, key=lambda r: r["doc_id"]):
        by_label.setdefault(r["label"], []).extend(p for _, _, p, ok in sentences(r["text"]) if ok)
    texts, labels = [], []
    rng = np.random.default_rng(seed)
    for c, name in enumerate(LANGUAGES):
        own = by_label.get(name, [])
        pick = rng.permutation(len(own))[: most_sentences // len(LANGUAGES)]
        texts += [own[i] for i in sorted(pick)]
        labels += [c] * len(pick)
    if len(set(labels)) < 2:
        return None
    fold = rng.integers(0, 3, len(texts))
    label = np.asarray(labels)
    keep = np.zeros(len(texts), bool)
    for k in range(3):  # wrong labels are seen by models that were not fitted to them
        model = KernelModel([t for t, f in zip(texts, fold, strict=True) if f != k], label[fold != k].tolist(), len(LANGUAGES), landmarks=LANDMARKS // 2)
        held = np.flatnonzero(fold == k)
        keep[held] = np.argmax(model.scores([texts[i] for i in held]), 1) == label[held]
    if len(set(label[keep])) < 2:
        keep[:] = True
    return KernelModel([t for t, k in zip(texts, keep, strict=True) if k], label[keep].tolist(), len(LANGUAGES))


def segment_units(units: list[tuple[int, int, str, bool]], logp: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(start, stop, language, confidence) of a document's segments from its counted units' log probabilities, where they differ.

    Viterbi with a price for each change of language; units that do not count go
    with the segment before them (at the start, the one after).
    """
    counted = [i for i, u in enumerate(units) if u[3]]
    n, classes = logp.shape
    rows, each, back = logp.tolist(), range(classes), []
    best = rows[0]
    for row in rows[1:]:
        top = max(each, key=best.__getitem__)
        change = best[top] - SWITCH
        back.append([c if best[c] >= change else top for c in each])
        best = [(v if v >= change else change) + w for v, w in zip(best, row, strict=True)]
    path = [max(each, key=best.__getitem__)]
    for step in reversed(back):
        path.append(step[path[-1]])
    path.reverse()
    out: list[list] = []
    for k, i in enumerate(counted):
        p = math.exp(rows[k][path[k]])
        if out and out[-1][2] == path[k]:
            out[-1][1] = units[i][1]
            out[-1][3].append(p)
        else:
            out.append([units[i][0] if out else units[0][0], units[i][1], path[k], [p]])
    out[-1][1] = units[-1][1]
    for a, b in zip(out[:-1], out[1:], strict=True):
        a[1] = b[0]
    return [(s, e, c, sum(p) / len(p)) for s, e, c, p in out]


def document_segments(documents: DataFrame, model: KernelModel | None = None) -> DataFrame:
    """The language of each segment of each document with words.

    Returned: doc_id, lang (as delivered), segment_no, language, confidence (mean
    probability of its sentences), start and stop (characters), segments (how many
    the document has). Segments are longest runs of whole sentences in one
    language; headings, numbers, identifiers, quotations and brackets start none.
    Null texts, texts without words and null doc_ids give no row; a document
    given twice is answered twice; extra columns are ignored; an empty table
    gives none. Whole texts are read, however long.
    """
    model = model or train(documents)
    if model is None:
        return documents.sparkSession.createDataFrame([], SEGMENT)
    # arrays only, bounded by the landmarks' n-grams: executors need no copy of the class
    shared = documents.sparkSession.sparkContext.broadcast(dict(vars(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = KernelModel.__new__(KernelModel)
        vars(own).update(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < 300_000):
                    size += len(texts[hi] or "")
                    hi += 1
                yield from _segment_batch(batch.slice(lo, hi - lo), texts[lo:hi], own)
                lo = hi

    usable = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return spread(usable.select("doc_id", "text", "lang")).mapInArrow(run, SEGMENT)


def _segment_batch(batch: pa.RecordBatch, texts: list[str], model: KernelModel) -> Iterator[pa.RecordBatch]:
    docs, plain = [], []
    for i, t in enumerate(texts):
        units = sentences(t)
        if not any(u[3] for u in units):  # short texts: anything with words that are not a heading's
            units = [(s, e, p, len(WORD.findall(p)) > 0 and any(ch.islower() or HAN.match(ch) for ch in t[s:e])) for s, e, p, _ in units]
        if any(u[3] for u in units):
            own = [u[2] for u in units if u[3]]
            docs.append((i, units, len(plain), len(plain) + len(own)))
            plain += own
    if not docs:
        return
    z = model.scores(plain) * SHARPNESS
    z -= z.max(1, keepdims=True)
    logp = z - np.log(np.exp(z).sum(1, keepdims=True))
    rows: list[tuple] = []
    # most documents have one language throughout: no change of it can pay, and no path is searched
    top = logp.argmax(1)
    sure = np.exp(logp[np.arange(len(top)), top])
    starts = np.array([d[2] for d in docs])
    alone = np.minimum.reduceat(top, starts) == np.maximum.reduceat(top, starts)
    mean = np.add.reduceat(sure, starts) / np.diff(np.append(starts, len(top)))
    for (i, units, a, b), one, p_all in zip(docs, alone.tolist(), mean.tolist(), strict=True):
        found = [(units[0][0], units[-1][1], int(top[a]), p_all)] if one else segment_units(units, logp[a:b])
        rows += [(i, k, LANGUAGES[c], p, s, e, len(found)) for k, (s, e, c, p) in enumerate(found)]
    col = list(zip(*rows, strict=True))
    at = pa.array(col[0])
    yield pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(2).take(at), pa.array(col[1], pa.int32()), pa.array(col[2]), pa.array(col[3], pa.float64()), pa.array(col[4], pa.int32()), pa.array(col[5], pa.int32()), pa.array(col[6], pa.int32())],
        names=["doc_id", "lang", "segment_no", "language", "confidence", "start", "stop", "segments"],
    )


def wrong_or_missing(segments: DataFrame) -> DataFrame:
    """Segments of documents without a label, with another language's label, or in several languages."""
    label = label_key(F.col("lang"))
    return segments.where(label.isNull() | (F.col("segments") > 1) | (label != F.col("language")))


def relabelled(documents: DataFrame) -> DataFrame:
    return wrong_or_missing(document_segments(documents)).select("doc_id", "segment_no", "language")
