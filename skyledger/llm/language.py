"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of order four over letters and single spaces (lower case; anything that is
no letter is a space). A model lies in sorted arrays of n-gram hashes: for each order the n-grams
seen in any language with their interpolated log probability in every language, and for each
context the back-off weights. A text goes to the language with the lowest cross-entropy per
character. Limits set on sample texts that the models did not see tell texts that no model explains;
they are rejected. A limit is a median and a margin, so a few odd texts under a label do not move it.

The fit reads a bounded sample: about ``sample_docs`` whole documents per language, chosen by a hash
of the id, or fewer where the model of many languages or large alphabets would be too large to be
sent to every task. Every text is then scored as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import map_batches, text_columns

ORDER = 4
SAMPLE_DOCS = 2000
LEAST_SAMPLE = 20
CALIBRATION_SHARE = 0.2
#: Letters a text needs to be rejected; below SHORT_LETTERS a name or a key is much of a text.
LEAST_LETTERS = 20
SHORT_LETTERS = 100
#: Nats per character above the median of the calibration texts that a short and a longer text may have:
#: these, or so many spreads (median deviations, scaled to a standard deviation) where that is more. On
#: 42,000 sample texts of four languages the worst are 2.35 (short) and 1.30 above it, random words 2.3
#: and more even where 3 % of the texts a model learned from are such.
MARGINS = (2.5, 1.75)
SPREADS = 8
#: Calibration texts that a language needs for a limit of its own, and a length class for its own spread.
LEAST_CALIBRATION = 5
LEAST_OF_CLASS = 50
UNKNOWN = "und"
#: Bytes of a model, which every task gets. With a larger one the sample is made smaller.
MAX_MODEL_BYTES = 256 << 20

_BOS = 1
_SPACE = 32
_CHARS_AT_ONCE = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def _factors() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2**63, ORDER, dtype=np.uint64) | np.uint64(1)


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols, the document of each, and the number of letters of each document. A document
    begins with ``ORDER - 1`` marks and a space."""
    lowered = [t.lower() for t in texts]
    head = "\x01" * (ORDER - 1) + " "
    joined = "".join(part for t in lowered for part in (head, t))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter((len(t) + len(head) for t in lowered), np.int64, len(lowered))
    starts = np.cumsum(lengths) - lengths
    letter = _letters()[codes]
    n_letters = np.add.reduceat(letter, starts, dtype=np.int64) if len(starts) else starts
    symbols = np.where(letter, codes, _SPACE)
    for i in range(ORDER - 1):
        symbols[starts + i] = _BOS
    keep = symbols != _SPACE
    keep[1:] |= symbols[:-1] != _SPACE
    doc = np.repeat(np.arange(len(texts)), lengths)
    return symbols[keep].astype(np.uint64), doc[keep], n_letters


def _hashes(symbols: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` symbols that end at each position from ``ORDER - 1`` on."""
    n = len(symbols) - (ORDER - 1)
    result = np.zeros(max(n, 0), np.uint64)
    for back in range(order):
        at = ORDER - 1 - back
        result += symbols[at : at + n] * _factors()[back]
    return result


def _context_hashes(symbols: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` symbols before each position from ``ORDER - 1`` on."""
    n = len(symbols) - (ORDER - 1)
    result = np.zeros(max(n, 0), np.uint64)
    for back in range(order):
        at = ORDER - 2 - back
        result += symbols[at : at + n] * _factors()[back]
    return result


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # by order - 1: sorted hashes
    log_p: list[np.ndarray]  # by order - 1: one row per hash, one column per language
    contexts: list[np.ndarray]  # by length of the context: sorted hashes
    log_backoff: list[np.ndarray]
    log_unseen: np.ndarray  # per language: a symbol never seen
    reject_above: np.ndarray  # cross-entropy: short and longer texts, per language

    @property
    def nbytes(self) -> int:
        parts = [*self.grams, *self.log_p, *self.contexts, *self.log_backoff]
        return sum(a.nbytes for a in parts)

    def _log_p(self, symbols: np.ndarray) -> np.ndarray:
        """Log probability of each symbol from ``ORDER - 1`` on in each language."""
        at, found = _find(self.grams[-1], _hashes(symbols, ORDER))
        result = self.log_p[-1][at]
        missing = np.flatnonzero(~found)
        if not len(missing):
            return result
        # back off, order by order, where the longer n-gram is unknown in all languages
        total = np.zeros((len(missing), len(self.languages)))
        open_ = np.arange(len(missing))
        for order in range(ORDER, 0, -1):
            where = missing[open_]
            if order < ORDER:
                grams = _hashes_at(symbols, where, order, 0)
                at, found = _find(self.grams[order - 1], grams)
                total[open_[found]] += self.log_p[order - 1][at[found]]
                open_ = open_[~found]
                where = missing[open_]
            if not len(open_):
                break
            length = order - 1
            at, found = _find(self.contexts[length], _hashes_at(symbols, where, length, 1))
            total[open_[found]] += self.log_backoff[length][at[found]]
        total[open_] += self.log_unseen
        result[missing] = total
        return result

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per symbol of each text in each language, symbols scored and letters."""
        symbols, doc, n_letters = _symbols(texts)
        scored = symbols[ORDER - 1 :] != _BOS
        log_p = self._log_p(symbols)[scored]
        of = doc[ORDER - 1 :][scored]
        counts = np.bincount(of, minlength=len(texts))
        sums = np.stack(
            [np.bincount(of, log_p[:, i], len(texts)) for i in range(len(self.languages))], axis=1
        )
        return -sums / np.maximum(counts, 1)[:, None], counts, n_letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and whether the text is rejected."""
        if not self.languages:
            n = len(texts)
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
        entropy, counts, n_letters = self.cross_entropy(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        weight = np.minimum(counts, 200)[:, None]
        score = 1 / np.exp((least[:, None] - entropy) * weight).sum(axis=1)
        none = n_letters == 0
        limit = self.reject_above[(n_letters >= SHORT_LETTERS).astype(int), best]
        rejected = none | ((least > limit) & (n_letters >= LEAST_LETTERS))
        names = [UNKNOWN if x else self.languages[i] for x, i in zip(none, best, strict=True)]
        return names, np.where(none, 0.0, score), least, rejected


def _hashes_at(symbols: np.ndarray, where: np.ndarray, length: int, back: int) -> np.ndarray:
    """As ``_hashes`` (``back`` 0) or ``_context_hashes`` (1), at some positions only."""
    result = np.zeros(len(where), np.uint64)
    for i in range(length):
        result += symbols[where + (ORDER - 1 - back - i)] * _factors()[i]
    return result


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang``, ``gram`` (ORDER code points as 32-bit integers) and ``n`` over all rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        langs = batch.column("lang").to_pylist()
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, batch.column("text"), strict=True):
            by_lang.setdefault(lang, []).append(text.as_py())
        out: list[tuple[str, np.ndarray, np.ndarray]] = []
        for lang, texts in by_lang.items():
            symbols = _symbols(texts)[0].astype("<u4")
            windows = np.lib.stride_tricks.sliding_window_view(symbols, ORDER)
            windows = np.ascontiguousarray(windows[windows[:, -1] != _BOS])
            grams, counts = np.unique(windows.view(f"V{4 * ORDER}").ravel(), return_counts=True)
            out.append((lang, grams, counts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x for x, g, _ in out for _ in range(len(g))], pa.string()),
                pa.array([y.tobytes() for _, g, _ in out for y in g], pa.binary()),
                pa.array(np.concatenate([c for _, _, c in out]), pa.int64()),
            ],
            ["lang", "gram", "n"],
        )

    parts = map_batches(labelled, run, "lang string, gram binary, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _language_model(grams: np.ndarray, counts: np.ndarray, alphabet: int) -> list[dict]:
    """Per order: n-grams with their discounted share, contexts with their back-off weight."""
    levels = []
    for order in range(ORDER, 0, -1):
        if order < ORDER:  # continuation counts: in how many ways an n-gram can be continued left
            grams, counts = np.unique(grams[:, 1:], axis=0, return_counts=True)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, inverse = np.unique(grams[:, :-1], axis=0, return_inverse=True)
        inverse = inverse.ravel()
        total = np.bincount(inverse, counts, len(contexts))
        kinds = np.bincount(inverse, minlength=len(contexts))
        levels.append(
            {
                "grams": grams,
                "share": (counts - discount) / total[inverse],
                "contexts": contexts,
                "backoff": discount * kinds / total,
            }
        )
    levels[-1]["uniform"] = 1 / alphabet
    return levels[::-1]


def _rows_hash(rows: np.ndarray) -> np.ndarray:
    result = np.zeros(len(rows), np.uint64)
    for back in range(rows.shape[1]):
        result += rows[:, rows.shape[1] - 1 - back].astype(np.uint64) * _factors()[back]
    return result


def build_model(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models out of ``{language: (n-grams as rows of code points, counts)}``."""
    languages = sorted(counts)
    k = len(languages)
    symbols = {int(s) for grams, _ in counts.values() for s in np.unique(grams[:, -1])}
    alphabet = len(symbols) + 1
    levels = {lang: _language_model(*counts[lang], alphabet) for lang in languages}
    grams_of, log_p_of, contexts_of, backoff_of = [], [], [], []
    below: np.ndarray | None = None  # probabilities of the order below, by its sorted hashes
    for order in range(1, ORDER + 1):
        all_contexts = np.unique(
            np.concatenate([levels[x][order - 1]["contexts"] for x in languages]), axis=0
        )
        hashes = _rows_hash(all_contexts)
        sort = np.argsort(hashes)
        context_keys = hashes[sort]
        backoff = np.ones((len(context_keys), k))  # an unseen context leaves all to the one below
        for i, lang in enumerate(languages):
            level = levels[lang][order - 1]
            at, _ = _find(context_keys, _rows_hash(level["contexts"]))
            backoff[at, i] = level["backoff"]
        all_grams = np.unique(
            np.concatenate([levels[x][order - 1]["grams"] for x in languages]), axis=0
        )
        hashes = _rows_hash(all_grams)
        sort = np.argsort(hashes)
        keys, all_grams = hashes[sort], all_grams[sort]
        at, _ = _find(context_keys, _rows_hash(all_grams[:, :-1]))
        if below is None:
            lower = np.full((len(keys), k), 1 / alphabet)
        else:
            lower_at, _ = _find(grams_of[-1], _rows_hash(all_grams[:, 1:]))
            lower = below[lower_at]
        p = backoff[at] * lower
        for i, lang in enumerate(languages):
            level = levels[lang][order - 1]
            own, _ = _find(keys, _rows_hash(level["grams"]))
            p[own, i] += level["share"]
        below = p
        grams_of.append(keys)
        log_p_of.append(np.log(p))
        contexts_of.append(context_keys)
        backoff_of.append(np.log(backoff))
    unseen = np.full(k, np.log(1 / alphabet))
    even = np.tile(-unseen, (len(MARGINS), 1))
    return Model(languages, grams_of, log_p_of, contexts_of, backoff_of, unseen, even)


def limits(entropy: np.ndarray, letters: np.ndarray) -> list[float]:
    """Cross-entropies above which a short and a longer text of a language are rejected, from those of
    its calibration texts. Less than half of them can be anything without moving a limit far."""
    median = np.median(entropy)
    off = np.abs(entropy - median)
    found = []
    for margin, own in zip(MARGINS, (letters < SHORT_LETTERS, letters >= SHORT_LETTERS), strict=True):
        spread = 1.4826 * np.median(off[own] if own.sum() >= LEAST_OF_CLASS else off)
        found.append(float(median + max(margin, SPREADS * spread)))
    return found


def _collected(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    table = counts.toArrow()
    langs = np.array(table.column("lang").to_pylist(), object)
    raw = b"".join(table.column("gram").to_pylist())
    grams = np.frombuffer(raw, "<u4").reshape(-1, ORDER)
    n = table.column("n").to_numpy()
    return {
        lang: (grams[own], n[own]) for lang in set(langs.tolist()) for own in [langs == lang]
    }


def fit(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, max_bytes: int = MAX_MODEL_BYTES
) -> Model:
    """Models of all languages of ``labelled`` (``doc_id``, ``text``, ``lang``).

    Rows with a null text or language are left out. The sample is by a hash of the id, so rows with
    the same id are in it together; a null id counts as any other value. Without any labelled row
    the model has no language. A language with fewer than ``LEAST_CALIBRATION`` calibration texts
    rejects what its model explains no better than an even guess among all symbols. While the model
    has more than ``max_bytes``, it is fitted again with at most half of the sample, down to
    ``LEAST_SAMPLE`` documents per language, fewer of which could leave a language without any.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "lang", "text"
    )
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [], [], [], [], np.zeros(0), np.zeros((len(MARGINS), 0)))
    sample_docs = min(sample_docs, max(sizes.values()))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(1000)) < 1000 * CALIBRATION_SHARE

    def drawn(of_language: int) -> DataFrame:
        share = F.create_map(
            *(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, of_language / n)))
        )
        return usable.where(draw < share[F.col("lang")])

    while True:
        sample = drawn(sample_docs)
        model = build_model(_collected(gram_counts(sample.where(~held))))
        if model.nbytes <= max_bytes or sample_docs <= LEAST_SAMPLE:
            break
        # a smaller sample is part of a larger one
        smaller = min(sample_docs // 2, sample_docs * max_bytes // model.nbytes)
        sample_docs = max(LEAST_SAMPLE, smaller)
    if not model.languages:
        return model
    shared = usable.sparkSession.sparkContext.broadcast(model)

    def calibrate(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        names, _, entropy, _ = shared.value.predict(texts)
        letters = _symbols(texts)[2]
        kept = (letters >= LEAST_LETTERS) & (
            np.array(names, object) == np.array(batch.column("lang").to_pylist(), object)
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(names, object)[kept], pa.string()),
                pa.array(letters[kept], pa.int64()),
                pa.array(entropy[kept], pa.float64()),
            ],
            ["lang", "letters", "entropy"],
        )

    # as few rows as the sample has documents
    seen = map_batches(
        sample.where(held), calibrate, "lang string, letters long, entropy double"
    ).toArrow()
    langs = np.array(seen.column("lang").to_pylist(), object)
    letters, entropy = (seen.column(c).to_numpy() for c in ("letters", "entropy"))
    for i, lang in enumerate(model.languages):
        own = langs == lang
        if own.sum() >= LEAST_CALIBRATION:
            model.reject_above[:, i] = limits(entropy[own], letters[own])
    return model


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected`` of every whole text.

    A null text or one without a letter is ``und``, score 0, rejected. Repeated rows are scored
    each; a null ``doc_id`` stays null. An empty table stays empty. Columns named in ``keep`` are
    passed through as the struct ``kept``, with the ``text``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passed = [F.struct(*keep).alias("kept")] if keep else []
    texts = docs.select(*text_columns(), *passed)
    more = ["text", "kept"] if keep else []
    more_types = "".join(f", {c} {texts.schema[c].dataType.simpleString()}" for c in more)

    def groups(texts: list[str]) -> Iterator[list[str]]:
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= _CHARS_AT_ONCE:
                yield texts[start : i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield texts[start:]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [shared.value.predict(g) for g in groups(batch.column("text").to_pylist())]
        columns = [
            batch.column("doc_id"),
            pa.array([x for p in parts for x in p[0]], pa.string()),
            *(pa.array(np.concatenate([p[i] for p in parts])) for i in (1, 2, 3)),
        ]
        names = ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"]
        columns.extend(batch.column(c) for c in more)
        return pa.RecordBatch.from_arrays(columns, names + more)

    schema = (
        "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
        + more_types
    )
    return map_batches(texts, run, schema)
