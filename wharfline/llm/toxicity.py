"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on what toxic text has and ordinary text has
not. A text is cut into windows of a few words; each is compressed with the ordinary dictionary alone and with the
toxic one before it. Windows of ordinary wording come out equally long, toxic wording comes out shorter by the bytes
its dictionary saves. Window savings make a few figures of a document, and a logistic curve, fitted on other labelled
rows than the dictionaries, turns them into a score; it is moved so that its
threshold lets at most ``ALLOWED`` of the ordinary calibration rows through to the wrong side.

The ordinary dictionary is zstandard's own training. Trained alike on toxic documents it would mostly hold ordinary wording,
so the toxic one is a cover: runs of a few bytes (``GRAMS``) that toxic documents have far more often than ordinary ones mark the
words, and the most frequent ones that hold all marked runs are its content. All learning is on bounded samples of labelled rows
that aren't held out (``TRAIN``, ``CALIBRATE``, ``SAMPLE_CHARS``); everything else is over whole texts. The sample is one
group of one task, and the driver gets the model alone: dictionaries and weights.

Defined results: a null, empty or blank text has no windows and gets the curve's lowest figures; without toxic
labels every score is 0; repeated rows score alike; null ids aren't held out (the empty text's crc32 is 0). Extra
columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import held_out, labelled_sample
from .tables import column
from .words import slices, words_of

#: Labelled rows of each class that train the dictionaries, and others that fit the curve.
TRAIN = {1: 1200, 0: 2400}
CALIBRATE = {1: 600, 0: 2400}
SAMPLE_CHARS = 20_000
#: Words in a window.
WINDOW = 8
#: Bytes of the dictionaries, zstandard's level and shortest match.
ORDINARY_BYTES, TOXIC_BYTES, LEVEL, MATCH = 8192, 2048, 9, 3
#: Runs of so many bytes mark toxic wording if so large a share and number of toxic documents have them, so many times the ordinary share.
GRAMS, LEAST_SHARE, LEAST_TEXTS, TIMES = (4, 5, 6, 8), 0.02, 6, 10
#: Texts whose runs are counted together.
TOGETHER = 64
#: Savings in bytes whose windows are counted.
STEPS = (2, 4, 6)
FIGURES = 3 + len(STEPS)
#: Scores from here on are predicted toxic; the curve is moved so that no larger share of ordinary calibration rows gets there.
THRESHOLD = 0.7
ALLOWED = 0.005

SCORE_SCHEMA = "doc_id long, figures array<double>"
MODEL_SCHEMA = "ordinary binary, toxic binary, weights array<double>"
_MODEL = pa.schema([("ordinary", pa.binary()), ("toxic", pa.binary()), ("weights", pa.list_(pa.float64()))])


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]


def _joined(texts: pa.Array) -> list[bytes]:
    """Each text's words, A-Z lowered, with one blank between them."""
    out: list[bytes] = []
    for begin, end in slices(texts, 1 << 20):
        words = words_of(texts.slice(begin, end - begin), lower=True)
        data = words.data.tobytes()
        cut = [data[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        out += [b" ".join(cut[a:b]) for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
    return out


def _grams(text: bytes, size: int) -> np.ndarray:
    """The run of that many bytes that begins at each place of a text, as a number."""
    data = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint64)
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[k : k + n]
    return out if size > 4 else out.astype(np.uint32)


def _shares(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of some texts, and the share of the texts that has it."""
    found, n = _grams(b"", size)[:0], np.zeros(0)
    for begin in range(0, len(texts), TOGETHER):  # some texts at a time: what is held are the distinct runs
        own = [np.unique(_grams(t, size)) for t in texts[begin : begin + TOGETHER]]
        found, at = np.unique(np.concatenate([found, *own]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n, np.ones(len(at) - len(n))]), len(found))
    return found, n / len(texts)


def _shares_of(grams: np.ndarray, texts: list[bytes], size: int) -> np.ndarray:
    """The share of some texts that has each of the runs, which are sorted."""
    n = np.zeros(len(grams))
    for text in texts if len(grams) else []:
        own = _grams(text, size)
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        n[np.unique(at[grams[at] == own])] += 1
    return n / len(texts)


def _marks(bad: list[bytes], good: list[bytes], size: int) -> np.ndarray:
    """The runs that mark toxic wording, sorted."""
    grams, share = _shares(bad, size)
    often = (share >= LEAST_SHARE) & (share * len(bad) >= LEAST_TEXTS)
    grams, share = grams[often], share[often]
    return grams[share >= TIMES * (_shares_of(grams, good, size) + 0.5 / len(good))]


def _marked_words(text: bytes, words: list[bytes], marks: dict[int, np.ndarray]) -> dict[int, set[tuple[int, int]]]:
    """The places of words that hold marked runs, with these runs."""
    found: dict[int, set[tuple[int, int]]] = {}
    ends = np.cumsum([len(w) + 1 for w in words])  # a word with the blank before it ends here
    for size, known in marks.items():
        grams = _grams(text, size)
        if not len(known) or not len(grams):
            continue
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        places = np.flatnonzero(known[at] == grams)
        for place, word in zip(places.tolist(), np.searchsorted(ends, places, side="right").tolist()):
            if word < len(words) and place + size <= ends[word] + 1:  # inside the word and the blanks around it
                found.setdefault(word, set()).add((size, int(grams[place])))
    return found


def _spans(texts: list[bytes]) -> Iterator[bytes]:
    """The texts in runs of eight words."""
    for text in texts:
        words = text.split()
        for i in range(0, len(words), 8):
            yield b" ".join(words[i : i + 8])


def _ordinary_dictionary(samples: list[bytes]) -> bytes:
    """zstandard's own training, or, of too little text for that, the text itself."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[:ORDINARY_BYTES].ljust(8)


def _cover(texts: list[bytes], marks: dict[int, np.ndarray]) -> bytes:
    """Words in the order of how many others they follow, each if it adds a run no word before it had.

    A run counts if it follows enough different words: one that always follows the same comes from copies of a text.
    Matches are cheapest near the end, so the most frequent words stand there.
    """
    follows: dict[bytes, set[bytes]] = {}
    runs: dict[bytes, set[tuple[int, int]]] = {}
    contexts: dict[tuple[int, int], set[bytes]] = {}
    for text in texts:
        words = text.split()
        for place, own in _marked_words(text, words, marks).items():
            word, before = words[place], words[place - 1] if place else b""
            follows.setdefault(word, set()).add(before)
            runs.setdefault(word, set()).update(own)
            for run in own:
                contexts.setdefault(run, set()).add(before)
    least = max(LEAST_TEXTS, LEAST_SHARE * len(texts))
    good = {run for run, before in contexts.items() if len(before) >= least}
    held, covered = b"", set()
    for word in sorted(follows, key=lambda w: (-len(follows[w]), w)):
        if runs[word] & good - covered:
            if len(held) + len(word) + 2 > TOXIC_BYTES:
                break
            held = b" " + word + b" " + held
            covered |= runs[word]
    return held.ljust(8)


def train_dictionaries(toxic: pa.Array, ordinary: pa.Array) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary."""
    bad, good = _joined(toxic), _joined(ordinary)
    spans = sum(-(-(t.count(b" ") + 1) // 8) for t in good if t)
    ordinary_dictionary = _ordinary_dictionary(list(islice(_spans(good), 0, None, max(1, spans // 20_000))))
    marks = {size: _marks(bad, good, size) for size in GRAMS}
    return ordinary_dictionary, _cover(bad, marks)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=8 * WINDOW, dict_size=len(dictionary), min_match=MATCH,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def _lengths(compressor: zstandard.ZstdCompressor, data: bytes, spans: np.ndarray) -> np.ndarray:
    packed = zstandard.BufferWithSegments(data, spans.astype("<u8").tobytes())
    out = compressor.multi_compress_to_buffer(packed, threads=1)
    return np.fromiter(map(len, out), np.int64, len(out))


def figures(texts: pa.Array, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> Iterator[np.ndarray]:
    """Of each text: the largest saving, the mean of the three largest, logs of the number of windows that save so
    much, and the mean saving."""
    for begin, end in slices(texts, 1 << 20):
        words = words_of(texts.slice(begin, end - begin), lower=True)
        data = words.data.tobytes()
        count = np.diff(words.first)
        each = -(-count // WINDOW)
        of = np.repeat(np.arange(len(each)), each)
        head = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * WINDOW
        first = words.first[:-1][of] + head
        last = np.minimum(first + WINDOW, words.first[1:][of]) - 1
        saved = np.zeros(0, np.int64)
        if len(of):
            spans = np.stack([words.starts[first], words.ends[last] - words.starts[first]], 1)
            saved = _lengths(ordinary, data, spans) - _lengths(toxic, data, spans)
        edges = np.searchsorted(of, np.arange(len(each) + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            own = np.sort(saved[a:b])[::-1]
            if len(own):
                yield np.array([own[0], own[:3].mean(), *[np.log1p((own >= k).sum()) for k in STEPS], np.maximum(own, 0).sum() / len(own)], float)
            else:
                yield np.zeros(FIGURES)


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Weighted logistic regression with a slight ridge, by Newton's steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1.0] * (x.shape[1] - 1)) * weight.sum() * 1e-4
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (weight * (p - y)) + ridge @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _moved(weights: list[float], x: np.ndarray, y: np.ndarray) -> list[float]:
    """The curve with its intercept moved: the threshold lies midway between the last ordinary row allowed and the next toxic row."""
    line = weights[0] + x @ np.array(weights[1:])
    ordinary = np.sort(line[y == 0])[::-1]
    bound = ordinary[min(int(ALLOWED * len(ordinary)), len(ordinary) - 1)]
    above = line[(y == 1) & (line > bound)]
    cut = (bound + above.min()) / 2 if len(above) else bound + 1.0
    return [weights[0] - float(cut) + float(np.log(THRESHOLD / (1 - THRESHOLD))), *weights[1:]]


def _learner(share: float):
    """share: of toxic ones among all labelled rows that aren't held out."""
    most = {k: TRAIN[k] + CALIBRATE[k] for k in TRAIN}

    def learnt(rows: pa.Table) -> list[Model]:
        rows = rows.take(pa.array(np.lexsort([rows.column(c).to_numpy() for c in ("at", "doc_id", "order")])))
        label, parts = rows.column("label").to_numpy(), {}
        for value in (0, 1):
            own = pa.concat_arrays([c.cast(pa.large_string()) for c in rows.column("text").filter(pa.array(label == value)).chunks] or [pa.array([], pa.large_string())])
            cut = TRAIN[value] * len(own) // max(most[value], 1) if len(own) < most[value] else TRAIN[value]
            parts[value] = (own[:cut], own[cut:])
        if not len(parts[1][0]) or not len(parts[1][1]) or not len(parts[0][1]):
            return []
        ordinary, toxic = train_dictionaries(parts[1][0], parts[0][0])
        pair = _compressor(ordinary), _compressor(toxic + ordinary)
        x = np.array([f for value in (1, 0) for f in figures(parts[value][1], *pair)])
        y = np.repeat([1.0, 0.0], [len(parts[1][1]), len(parts[0][1])])
        # the classes weigh as they occur among all labelled rows that aren't held out
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        return [Model(ordinary, toxic, _moved(_curve(x, y, weight), x, y))]

    def run(rows: pa.Table) -> pa.Table:
        out = pa.Table.from_pylist([vars(m) for m in learnt(rows)], _MODEL)
        pa.default_memory_pool().release_unused()  # a worker process lives on beside later stages
        return out

    return run


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Dictionaries and curve from bounded samples of labelled rows that aren't held out; None without toxic ones.

    The rows of the sample are learnt from by one task; of equal ids the earlier row comes first.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if share is None:
        return None
    rows = labelled_sample(docs, labels, "toxic", {k: TRAIN[k] + CALIBRATE[k] for k in TRAIN}, SAMPLE_CHARS)
    rows = rows.select("text", "label", "order", "doc_id", F.monotonically_increasing_id().alias("at"))
    found = rows.groupBy().applyInArrow(_learner(float(share)), MODEL_SCHEMA).first()
    return Model(bytes(found.ordinary), bytes(found.toxic), list(found.weights)) if found else None


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)
        weights = np.array(model.weights)
        for batch in batches:
            x = np.array(list(figures(batch.column("text"), *pair))).reshape(-1, FIGURES)
            score = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64())], [*names, "score"])

    return run


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    if model is None:
        out = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        out = rows.mapInArrow(_score(model), "doc_id long, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, train(docs, labels))


def _clean(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)
        weights = np.array(model.weights)
        for batch in batches:
            texts = batch.column("row").field("text")
            x = np.array(list(figures(texts, *pair))).reshape(-1, FIGURES)
            score = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            yield batch.filter(pa.array(score < THRESHOLD))

    return run


def without_toxic(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, whole; the model is trained on ``training`` and ``labels``."""
    model = train(training, labels)
    if model is None:
        return docs
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return packed.mapInArrow(_clean(model), packed.schema).select("row.*")
