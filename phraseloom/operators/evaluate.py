"""Exact match, corpus BLEU and greedy token F1 over (pair_id, prediction, reference)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.language import require_language
from phraseloom.functions.text import as_column, emit_json, is_blank, strip, tokens
from phraseloom.operators.encode import gram_counts
from phraseloom.operators.detector import detect
from phraseloom.operators.translate import literal_passthrough, translate_rows
from phraseloom.storage import stored


def exact_match(df: DataFrame) -> DataFrame:
    """Pairs, equal pairs after strip, and percent."""
    equal = F.count_if(strip("prediction") == strip("reference"))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("pairs"),
        equal.alias("exact_matches"),
        F.when(n > 0, equal / n * 100).otherwise(0.0).alias("exact_match_pct"),
    )


def _plain_text(c: Column | str) -> Column:
    """The text without trailing white space and with the literals of the 13a rules replaced."""
    text = F.coalesce(as_column(c), F.lit(""))
    # Most texts end in a visible character, and the last one tells.
    ends_blank = is_blank(F.substring(text, -1, 1))
    text = F.when(ends_blank, F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]++\z", "")).otherwise(text)
    for old, new in V.BLEU_LITERALS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def bleu_tokens(c: Column | str) -> Column:
    """Tokens of the public 13a rules, as a column. The score itself scans bytes, which is faster: scan_tokens()."""
    text = F.concat(F.lit(" "), _plain_text(c), F.lit(" "))
    for pattern, new in V.BLEU_PATTERNS:
        text = F.regexp_replace(text, pattern, new)
    return tokens(text)


COUNTS = ["sys_len", "ref_len", *[f"{kind}{n}" for kind in ("total", "match") for n in range(1, V.BLEU_MAX_ORDER + 1)]]
ROWS_AT_ONCE = 200
# Bytes of text that are scanned for n-grams at a time; a longer row is taken by itself.
TEXT_AT_ONCE = 1 << 20
GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _grams(codes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Every n-gram as one number that also holds its row."""
    size = max(0, len(codes) - n + 1)
    h = _spread(row[:size].astype(np.uint64) + np.uint64(1))
    for k in range(n):
        h = _spread(h * GRAM_BASE + codes[k : size + k].astype(np.uint64))
    return h[row[:size] == row[n - 1 : size + n - 1]]


# Classes of a byte for the scanner, by the rules of fixed_values.BLEU_PATTERNS.
_BLANK, _SYMBOL, _STOP, _DASH, _DIGIT, _OTHER = range(6)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _OTHER, np.uint8)
    for low, high in (("!", "&"), ("(", "+"), (":", "@"), ("[", "`"), ("{", "~"), ("/", "/")):
        classes[ord(low) : ord(high) + 1] = _SYMBOL
    classes[ord("0") : ord("9") + 1] = _DIGIT
    classes[[ord(","), ord(".")]] = _STOP
    classes[ord("-")] = _DASH
    classes[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = _BLANK
    return classes


def _wide_blanks(data: np.ndarray, classes: np.ndarray) -> None:
    """Class the bytes of white space beyond ASCII as blanks, in place."""
    for char in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))):
        code = char.encode()
        at = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0]) if len(data) >= len(code) else np.zeros(0, np.int64)
        for k in range(1, len(code)):
            at = at[data[at + k] == code[k]]
        for k in range(len(code)):
            classes[at + k] = _BLANK


def scan_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of some texts, one after the other, and the text of each; the same as bleu_tokens() after its literals.

    One pass over the bytes. A symbol is a token. Of a run of stops, all but the last are tokens, and so is the last
    unless a digit follows; then the pairs that the rules take from left to right decide: it is a token if the run is
    odd after a character that is no digit, or even after a digit. A dash after a digit is a token.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    # A blank byte on both sides of every text keeps texts apart.
    sizes = np.diff(offsets)
    room = np.full(len(data) + len(sizes) + 1, ord(" "), np.uint8)
    own = np.arange(len(data)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    room[own] = data
    kind = _CLASSES[room]
    if (room >= 0xC2).any():
        _wide_blanks(room, kind)
    before, after = kind[:-1], kind[1:]  # neighbours across every gap
    cut = (before == _SYMBOL) | (after == _SYMBOL) | (before == _BLANK) | (after == _BLANK)

    stop = kind == _STOP
    first, last = np.flatnonzero(stop[1:] & ~stop[:-1]) + 1, np.flatnonzero(stop[:-1] & ~stop[1:])
    if len(first):
        digit_before, digit_after = kind[first - 1] == _DIGIT, kind[last + 1] == _DIGIT
        odd = (last - first) % 2 == 0
        alone = ~digit_after | (odd != digit_before)
        cut[:-1] |= stop[:-2] & stop[1:-1]  # between two stops
        cut[last[alone]] = True
        cut[first - 1] |= (last > first) | alone
    dash = np.flatnonzero((kind[1:] == _DASH) & (kind[:-1] == _DIGIT)) + 1
    cut[dash - 1] = cut[dash] = True

    inside = kind != _BLANK
    starts = np.flatnonzero(inside[1:] & cut) + 1
    kept = room[inside]
    ends = np.append(np.cumsum(inside)[starts] - 1, len(kept))  # offsets of the starts among the kept bytes
    tokens_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)])
    texts_from = np.cumsum(sizes + 1) - sizes
    return tokens_, np.searchsorted(texts_from, starts, side="right") - 1


_CLASSES = _byte_classes()


def _runs(sizes: np.ndarray, most: int, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Start and end of runs of rows with sizes of at most `most` in all, or of one row, and of at most `rows` rows."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + most, side="right")))
        stop = stop if rows is None else min(stop, start + rows)
        yield start, stop
        start = stop


def _bytes_of(column: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.binary_length(column).fill_null(0)).astype(np.int64)


def _clipped(batch: pa.RecordBatch) -> dict[str, int]:
    """Lengths, and total and clipped matched n-grams per order, summed over the rows of a batch."""
    scanned = [scan_tokens(batch.column(c)) for c in ("p", "r")]
    codes = pa.concat_arrays([part for part, _ in scanned]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    n_first = len(scanned[0][0])
    sides = [(codes[:n_first], scanned[0][1]), (codes[n_first:], scanned[1][1])]
    out = {"sys_len": n_first, "ref_len": len(codes) - n_first}
    for n in range(1, V.BLEU_MAX_ORDER + 1):
        (a, in_a), (b, in_b) = (np.unique(_grams(*side, n), return_counts=True) for side in sides)
        _, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        out[f"total{n}"], out[f"match{n}"] = int(in_a.sum()), int(np.minimum(in_a[at], in_b[bt]).sum())
    return out


def bleu_statistics(df: DataFrame) -> DataFrame:
    """One row: lengths, and total and matched n-grams per order.

    Both texts are in one row, so n-grams are counted and clipped where they are read, and only sums move.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _bytes_of(batch.column("p")) + _bytes_of(batch.column("r"))
            for start, stop in _runs(sizes, TEXT_AT_ONCE, ROWS_AT_ONCE):
                sums = _clipped(batch.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays([pa.array([sums[c]], pa.int64()) for c in COUNTS], names=COUNTS)

    texts = df.select(_plain_text("prediction").alias("p"), _plain_text("reference").alias("r"))
    sums = texts.mapInArrow(scan, ", ".join(f"{c} bigint" for c in COUNTS))
    return sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def bleu_score(stats: DataFrame) -> DataFrame:
    """Score 0 to 100 with exponential smoothing and the brevity penalty.

    The k-th order without a match counts as 100 / (2^k * total). If nothing matches at all, or if no
    text has four tokens, the score is 0.
    """
    orders = range(1, V.BLEU_MAX_ORDER + 1)
    any_match = sum((F.col(f"match{n}") for n in orders), F.lit(0)) > 0
    log_sum, zeros = F.lit(0.0), F.lit(0)
    for n in orders:
        match, total = F.col(f"match{n}"), F.col(f"total{n}")
        zeros = zeros + F.when((match == 0) & (total > 0), 1).otherwise(0)
        smoothed = 100.0 / (F.pow(F.lit(2.0), zeros) * total)
        log_sum = log_sum + F.log(F.when(match == 0, smoothed).otherwise(100.0 * match / total))
    shorter = F.col("sys_len") < F.col("ref_len")
    penalty = F.when(shorter, F.exp(1 - F.col("ref_len") / F.col("sys_len"))).otherwise(1.0)
    usable = any_match & (F.col(f"total{V.BLEU_MAX_ORDER}") > 0) & (F.col("sys_len") > 0)
    score = F.when(usable, penalty * F.exp(log_sum / V.BLEU_MAX_ORDER)).otherwise(0.0)
    return stats.withColumn("bleu", score)


def corpus_bleu(df: DataFrame) -> DataFrame:
    """One row with the score and the statistics behind it."""
    return bleu_score(bleu_statistics(df))


SIMS_AT_ONCE = 4_000_000
# Tokens whose vectors are held at a time; a longer row is taken by itself.
TOKENS_AT_ONCE = 8_192


def _greedy_f1(pred: np.ndarray, ref: np.ndarray) -> float:
    """Precision is the mean best match of the prediction tokens, recall that of the reference tokens."""
    if not len(pred) or not len(ref):
        return 0.0
    best_pred, best_ref = [], np.full(len(ref), -np.inf)
    step = max(1, SIMS_AT_ONCE // len(ref))
    for i in range(0, len(pred), step):
        sims = pred[i : i + step] @ ref.T
        best_pred.append(sims.max(axis=1))
        best_ref = np.maximum(best_ref, sims.max(axis=0))
    p, r = np.concatenate(best_pred).mean(), best_ref.mean()
    return float(2 * p * r / (p + r)) if p + r != 0 else 0.0


def _pair_scores(df: DataFrame, left: str, right: str, score: Callable[[], Callable]) -> DataFrame:
    """(pair_id, f1) where score() gives a function of the two columns of a batch to a list of numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_batch = score()
        for batch in batches:
            values = of_batch(batch.column(left), batch.column(right))
            yield pa.RecordBatch.from_arrays([batch.column("pair_id"), pa.array(values, type=pa.float64())], names=["pair_id", "f1"])

    id_type = df.schema["pair_id"].dataType.simpleString()
    return df.select("pair_id", left, right).mapInArrow(scan, f"pair_id {id_type}, f1 double")


def pair_token_f1(df: DataFrame) -> DataFrame:
    """(pair_id, f1) from rows (pair_id, prediction_vectors, reference_vectors), unit vectors per token.

    Both sides are in one row, so no join and no pairs of tokens leave the task.
    """

    def matrices(column: pa.Array) -> list[np.ndarray]:
        """A list of vectors per row, as views of one flat array."""
        tokens_of = np.asarray(pa.compute.list_value_length(column).fill_null(0))
        vectors = column.flatten()
        width = pa.compute.max(pa.compute.list_value_length(vectors)).as_py() or 0
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, max(1, width))
        ends = np.cumsum(tokens_of)
        return [flat[end - n : end] for n, end in zip(tokens_of.tolist(), ends.tolist())]

    def score():
        return lambda preds, refs: [_greedy_f1(p, r) for p, r in zip(matrices(preds), matrices(refs))]

    return _pair_scores(df, "prediction_vectors", "reference_vectors", score)


def greedy_token_f1(df: DataFrame) -> DataFrame:
    """Mean over pairs of the greedy token F1."""
    return pair_token_f1(df).agg(F.avg("f1").alias("token_f1"))


def text_token_f1(df: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]] | None = None) -> DataFrame:
    """(pair_id, f1) from the texts (pair_id, prediction, reference).

    `load` builds a token encoder as in the encoder hook; the default is the built-in one. Vectors are
    made and used inside the task, once per distinct token of a few rows, and never stored.
    """

    def sizes_of(column: pa.Array) -> np.ndarray:
        return np.asarray(pa.compute.list_value_length(column).fill_null(0)).astype(np.int64)

    def score():
        model = load() if load is not None else (lambda words: gram_counts([f" {w.lower()} " for w in words]))

        def of_rows(preds: list[list[str]], refs: list[list[str]]) -> list[float]:
            words = sorted({w for text in (*preds, *refs) for w in text})
            vectors = np.zeros((0, 0))
            for i in range(0, len(words), 1024):
                part = np.asarray(model(words[i : i + 1024]), dtype=np.float64)
                norms = np.linalg.norm(part, axis=1, keepdims=True)
                if i == 0:
                    vectors = np.empty((len(words), part.shape[1]))
                vectors[i : i + 1024] = part / np.where(norms > 0, norms, 1.0)
            at = {w: i for i, w in enumerate(words)}
            return [_greedy_f1(vectors[[at[w] for w in p]], vectors[[at[w] for w in r]]) if p and r else 0.0 for p, r in zip(preds, refs)]

        def of_batch(preds: pa.Array, refs: pa.Array) -> list[float]:
            values = []
            for start, stop in _runs(sizes_of(preds) + sizes_of(refs), TOKENS_AT_ONCE):
                sides = ([t or [] for t in side.slice(start, stop - start).to_pylist()] for side in (preds, refs))
                values += of_rows(*sides)
            return values

        return of_batch

    words = df.select("pair_id", tokens("prediction").alias("p"), tokens("reference").alias("r"))
    return _pair_scores(words, "p", "r", score)


def evaluate_translations(
    test: DataFrame,
    index: DataFrame,
    detector,
    language: str,
    n: int | None = None,
    translator: Callable[[DataFrame], DataFrame] | None = None,
    encoder: Callable[[Column], Column] | None = None,
    token_model: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    **how,
) -> DataFrame:
    """One report row for a language over all rows, or the first n, of (input_text, target_text, target_lang, row_ord)."""
    code = require_language(language)
    picked = test.filter(F.col("target_lang") == code)
    if n is not None:
        picked = picked.orderBy("row_ord").limit(n)
    inputs = picked.select(
        emit_json("row_ord").alias("query_id"),
        F.col("input_text").alias("text"),
        F.col("target_text").alias("reference"),
        F.lit(language).alias("target_language"),
    )
    chosen = {} if translator is None else {"translator": translator}
    answered = translate_rows(detect(inputs, detector), index, encoder=encoder, **chosen, **how)
    pairs = literal_passthrough(answered).select(F.col("query_id").alias("pair_id"), "prediction", "reference")
    # Four measures read the pairs; the model must run once.
    pairs = stored(pairs)
    failed = pairs.agg(F.count_if(F.col("prediction") == V.TRANSLATION_FAILED).alias("failures"))
    parts = [
        exact_match(pairs),
        corpus_bleu(pairs).select("bleu"),
        text_token_f1(pairs, token_model).agg(F.avg("f1").alias("token_f1")),
        failed,
    ]
    # Each part is one row with its own columns; together they are one row.
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).select(F.lit(language).alias("language"), "*")
