"""Language identification by a linear-chain conditional random field.

Words are labelled with languages: affixes, character n-grams and a lexicon
score each word, learned transitions join neighbouring words, and the
forward-backward recursions give each word's posterior, so text that switches
language is followed. A document's language is the one with the largest share
of posterior mass.

The field is trained on the driver on a bounded sample: at most
``SAMPLE_PER_LANGUAGE`` labelled rows of each language, of at most
``SAMPLE_CHARS`` code points each, chosen by a hash. Training sequences switch
between rows, so that the transitions are learned from real switches.

Null texts and texts without a letter are ``und`` with score 0; rows without a
language or an id are not learned from; repeated rows are rows of their own;
an empty table gives an empty result; with nothing to learn from, all is
``und``; other columns are kept by :func:`identified` and ignored by
:func:`predicted`.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioframe.llm.common import bound_batches, grouped, held

SAMPLE_PER_LANGUAGE = 150
SAMPLE_CHARS = 20_000
#: Hashed features; words of a training sequence; sequences a step; passes; learning rate.
BUCKETS = 1 << 16
SEQUENCE, STEP, EPOCHS, RATE = 64, 96, 4, 0.3
#: Words a Python worker remembers, and code points it labels at once.
CACHED_WORDS = 300_000
GROUP_CHARS = 2 << 20
#: Words in a block; blocks are joined by their transfer matrices.
BLOCK = 32

_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


#: Letters of a word; only the pieces of longer runs depend on it.
LONGEST = 40


def words_of(text: str) -> list[str]:
    """Words in lower case; longer runs of letters (scripts without spaces) are cut into pieces of ``LONGEST``."""
    words = _WORD.findall(text.lower())
    if any(len(w) > LONGEST for w in words):
        words = [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def features(word: str) -> list[int]:
    """Hashes of the affixes (to 4 letters) and the n-grams (2 and 3) of a word."""
    n = len(word)
    out = [f"p:{word[:k]}" for k in range(1, min(n, 4) + 1)]
    out += [f"s:{word[n - k:]}" for k in range(1, min(n, 4) + 1)]
    shown = f"^{word}$"
    out += [shown[i:i + 2] for i in range(len(shown) - 1)]
    out += [shown[i:i + 3] for i in range(len(shown) - 2)]
    crc = zlib.crc32
    return [crc(f.encode()) % BUCKETS for f in out]


@dataclass
class Field:
    """Weights of a trained field."""

    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # from x to
    lexicon: np.ndarray  # sorted hashes of words
    scores: np.ndarray  # of the lexicon's words, by language
    trust: np.ndarray  # weight of the lexicon, by language

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each word and language."""
        lists = [features(w) for w in words]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((f for fs in lists for f in fs), np.int64, int(size.sum()))
        out = np.add.reduceat(self.weights[flat], np.cumsum(size) - size, axis=0)
        return out + self.trust * self.lexicon_scores(words)

    def lexicon_scores(self, words: list[str]) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(words), len(self.languages)), np.float32)
        key = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
        at = np.minimum(np.searchsorted(self.lexicon, key), len(self.lexicon) - 1)
        return np.where((self.lexicon[at] == key)[:, None], self.scores[at], 0)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def posteriors(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Posterior of each word's language. Texts follow each other in ``emissions``; all have one word at least.

    Texts are cut into blocks; each block's transfer matrix carries the
    messages across it, so that all blocks are worked on at the same time.
    """
    k = emissions.shape[1]
    move = np.exp(transitions)
    blocks = -(-lengths // block)
    begin = np.cumsum(lengths) - lengths
    first = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(lengths)), blocks)
    inside = np.arange(len(owner)) - first[owner]
    at = (begin[owner] + inside * block)[:, None] + np.arange(block)
    real = inside[:, None] * block + np.arange(block) < lengths[owner][:, None]
    potential = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-30
    p = potential[np.where(real, at, 0)]

    # Transfer matrix of each block: from the message before it to the one at its end.
    across = np.broadcast_to(np.eye(k), (len(owner), k, k))
    for t in range(block):
        nxt = np.matmul(across, move) * p[:, t, None, :]
        nxt /= nxt.sum(axis=(1, 2), keepdims=True)
        across = np.where(real[:, t, None, None], nxt, across)
    before, after = np.full((len(owner), k), 1 / k), np.full((len(owner), k), 1 / k)
    for step in range(1, int(blocks.max())):
        texts = np.flatnonzero(blocks > step)
        here = first[texts] + step
        before[here] = _scaled(np.einsum("ni,nij->nj", before[here - 1], across[here - 1]))
        here = first[texts] + blocks[texts] - step  # counted from the last block
        after[here - 1] = _scaled(np.einsum("nij,nj->ni", across[here], after[here]))
    forward = np.empty((block, len(owner), k))
    message = before
    for t in range(block):
        nxt = _scaled((message @ move) * p[:, t])
        message = forward[t] = np.where(real[:, t, None], nxt, message)
    out = np.empty((block, len(owner), k))
    message = after
    for t in range(block - 1, -1, -1):
        out[t] = _scaled(forward[t] * message + 1e-30)
        nxt = _scaled((message * p[:, t]) @ move.T)
        message = np.where(real[:, t, None], nxt, message)
    return out.transpose(1, 0, 2)[real]


def train(rows: list[tuple[str, str]], seed: int = 3) -> Field | None:
    """A field from (text, language) rows; None if there is no word."""
    texts = [(words_of(t), lang) for t, lang in rows]
    texts = [([w for w in ws if any(map(str.isalpha, w))], lang) for ws, lang in texts]
    texts = [(ws, lang) for ws, lang in texts if ws]
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in texts})
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    vocabulary: dict[str, int] = {}
    coded = [(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws]), number[lang]) for ws, lang in texts]

    # Lexicon: words that occur twice, by how much likelier they are in a language than on average.
    counts = np.zeros((len(vocabulary), k))
    for ws, lang in coded:
        np.add.at(counts, (ws, lang), 1)
    share = (counts + 0.1) / (counts.sum(axis=0) + 0.1 * len(vocabulary))
    score = np.clip(np.log(share) - np.log(share.mean(axis=1, keepdims=True)), -3, 3).astype(np.float32)
    names = list(vocabulary)
    often = np.flatnonzero(counts.sum(axis=1) >= 2)
    key = np.array([zlib.crc32(names[i].encode()) for i in often], np.int64)
    key, first = np.unique(key, return_index=True)
    field = Field(languages, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)), key, score[often[first]], np.full(k, 0.1))

    # Sequences of spans of 5 to 60 words from rows in random order: every row's words occur once.
    spans = []
    for ws, lang in coded:
        at = 0
        while at < len(ws):
            n = int(rng.integers(5, 61))
            spans.append((ws[at:at + n], lang))
            at += n
    order = rng.permutation(len(spans))
    stream = np.concatenate([spans[i][0] for i in order])
    label = np.concatenate([np.full(len(spans[i][0]), spans[i][1]) for i in order])
    keep = max(len(stream) // SEQUENCE, 1) * SEQUENCE
    stream, label = np.resize(stream, keep).reshape(-1, SEQUENCE), np.resize(label, keep).reshape(-1, SEQUENCE)

    lists = [features(w) for w in names]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((f for fs in lists for f in fs), np.int64, int(size.sum()))
    begin = np.cumsum(size) - size
    lex = field.lexicon_scores(names)
    moved = {name: np.full(x.shape, 1e-3) for name, x in (("weights", field.weights), ("transitions", field.transitions), ("trust", field.trust))}

    def ascend(name, x, gradient, rows_=slice(None)):
        moved[name][rows_] += gradient**2
        x[rows_] += RATE * gradient / np.sqrt(moved[name][rows_])

    one = np.eye(k)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(stream)), max(len(stream) // STEP, 1)):
            ws, which = np.unique(stream[part], return_inverse=True)
            which = which.reshape(len(part), SEQUENCE)
            take = np.concatenate([np.arange(begin[w], begin[w] + size[w]) for w in ws])
            cut = np.cumsum(size[ws]) - size[ws]
            emission = np.add.reduceat(field.weights[flat[take]], cut, axis=0) + field.trust * lex[ws]
            truth = one[label[part]]
            marginal, pairs = _expected(emission[which], field.transitions)
            error = truth - marginal
            by_word = np.zeros((len(ws), k))
            np.add.at(by_word, which.ravel(), error.reshape(-1, k))
            by_word /= len(part)
            slots, slot = np.unique(flat[take], return_inverse=True)
            gradient = np.zeros((len(slots), k))
            np.add.at(gradient, slot, np.repeat(by_word, size[ws], axis=0))
            ascend("weights", field.weights, gradient - 1e-5 * field.weights[slots], slots)
            ascend("trust", field.trust, (by_word * lex[ws]).sum(axis=0))
            seen = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
            ascend("transitions", field.transitions, (seen - pairs) / len(part))
    return field


def _expected(emission: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of sequences of one length, and expected counts of transitions."""
    move = np.exp(transitions)
    p = np.exp(emission - emission.max(axis=2, keepdims=True)) + 1e-30
    n, length, k = p.shape
    forward, backward = np.empty_like(p), np.empty_like(p)
    message = np.full((n, k), 1 / k)
    for t in range(length):
        message = forward[:, t] = _scaled((message @ move) * p[:, t])
    message = np.full((n, k), 1 / k)
    for t in range(length - 1, -1, -1):
        backward[:, t] = message
        message = _scaled((message * p[:, t]) @ move.T)
    pairs = np.zeros((k, k))
    for t in range(1, length):
        joint = forward[:, t - 1, :, None] * move * (p[:, t] * backward[:, t])[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return _scaled(forward * backward), pairs


class _Slots(dict):
    """A place for each word; new words wait in ``new`` for their scores. Words without a letter get -1."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        if word.isalpha() or any(map(str.isalpha, word)):
            at = self[word] = self.used
            self.used += 1
            self.new.append(word)
        else:
            at = self[word] = -1
        return at

    used = 0


class Labeller:
    """Labels the words of texts; remembers the scores of words."""

    def __init__(self, field: Field):
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.slots = _Slots()
        self.table = np.empty((1 << 12, len(self.field.languages)))

    def label(self, texts: list[str]) -> list[np.ndarray]:
        """Posteriors (words x languages) of each text's words that hold a letter."""
        if len(self.slots) > CACHED_WORDS:
            self.forget()
        slots = self.slots
        at = [np.fromiter(map(slots.__getitem__, words_of(t)), np.int64) for t in texts]
        if slots.new:
            scores = self.field.emissions(slots.new)
            if slots.used > len(self.table):
                self.table = np.resize(self.table, (2 * slots.used, self.table.shape[1]))
            self.table[slots.used - len(slots.new):slots.used] = scores
            slots.new = []
        at = [a[a >= 0] for a in at]
        some = [i for i, a in enumerate(at) if len(a)]
        out = [np.empty((0, self.table.shape[1]))] * len(texts)
        if some:
            size = np.array([len(at[i]) for i in some])
            found = posteriors(self.table[np.concatenate([at[i] for i in some])], size, self.field.transitions)
            for i, part in zip(some, np.split(found, np.cumsum(size)[:-1]), strict=True):
                out[i] = part
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """``(start, end, language)`` of the runs of words with one language, in code points of the lower-cased text."""
        places = [m.span() for m in _WORD.finditer(text.lower()) if any(map(str.isalpha, m[0]))]
        out: list[tuple[int, int, str]] = []
        for (a, b), p in zip(places, self.label([text])[0], strict=True):
            lang = self.field.languages[int(p.argmax())]
            if out and out[-1][2] == lang:
                out[-1] = (out[-1][0], b, lang)
            else:
                out.append((a, b, lang))
        return out


def held_out(docs: DataFrame):
    """Whether a row is kept from training: the CRC-32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.encode(docs["doc_id"].cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame) -> Field | None:
    """A field from the sample of labelled rows that are not held out."""
    usable = docs.where(~held_out(docs) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
                        & (F.length("text") <= SAMPLE_CHARS))
    chosen = usable.select("lang", F.xxhash64("doc_id", "text").alias("mark"))
    chosen = chosen.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark"))).where(f"n <= {SAMPLE_PER_LANGUAGE}")
    marks = sorted({r["mark"] for r in chosen.select("mark").collect()})
    if not marks:
        return None
    rows = (usable.where(F.xxhash64("doc_id", "text").isin(marks)).select("text", "lang", F.xxhash64("doc_id", "text").alias("mark"))
            .dropDuplicates(["mark"]).collect())
    return train([(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: r["mark"])])


def _labelled(field: Field | None, texts: list[str]) -> tuple[list[str], list[float]]:
    if field is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    labeller = held(("language", zlib.crc32(field.weights.tobytes())), lambda: Labeller(field))
    names, scores = [], []
    for group in grouped(texts, GROUP_CHARS, len):
        for found in labeller.label(group):
            share = found.mean(axis=0) if len(found) else None
            names.append(UNKNOWN if share is None else field.languages[int(share.argmax())])
            scores.append(0.0 if share is None else min(float(share.max()), 1.0))
    return names, scores


def identified(docs: DataFrame, field: Field | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The documents with two more columns: predicted language and its share."""
    bound_batches(docs.sparkSession)
    field = field or trained(docs)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            got, score = _labelled(sent.value, [t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)


def predicted(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of all documents."""
    field = trained(docs)
    rows = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return identified(rows, field).select("doc_id", "held_out", "lang_pred", "score") if field else rows.select(
        "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))


def accepted(docs: DataFrame, least: float = 1 / 3) -> DataFrame:
    """The documents with a language: those that are ``und`` or whose best language has a smaller share than ``least`` go."""
    marked = identified(docs, names=("_lang_pred", "_lang_share"))
    return marked.where((F.col("_lang_pred") != UNKNOWN) & (F.col("_lang_share") >= least)).select(*docs.columns)
