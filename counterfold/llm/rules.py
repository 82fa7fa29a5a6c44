"""Quality rules: fixed counts, and divergence from what a language looks like.

Each language of the corpus has two reference histograms, taken from all its documents:
classes of characters, and its most common words, of any length and script, beside all others.
Shares of classes are geometric means over documents, which a minority of odd ones hardly moves.
A document is compared with every reference by the Jensen-Shannon distance and judged by the
nearest.  Short texts have noisy histograms, so each comparison needs a least length.  Documents of a
language too small for a reference are not compared: only the counts judge them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import SPACE, byte_texts, give_back, parts, ship, stored, unlike

SYMBOLS = b"#*$%&|<>"
CLASSES = ["lower", "upper", "digit", "space", "stop", "symbol", "mark", "other", "control"]
LONG = 64  # bytes of the longest word that stands for itself among the common ones
ENTRY = 100  # bytes that a counted word needs beside its own
LITTLE = 1e-4  # a share that does not matter
RUN = 8  # words in a repeated window
PAIRS = 1 << 16  # windows compared together

CLASS_OF = np.full(256, CLASSES.index("control"), np.uint8)
CLASS_OF[33:127] = CLASSES.index("mark")
CLASS_OF[128:] = CLASSES.index("other")
for _name, _bytes in {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789",
    "space": SPACE, "stop": b".,", "symbol": SYMBOLS,
}.items():
    CLASS_OF[list(_bytes)] = CLASSES.index(_name)
CLASS_OF[128:192] = 255  # a code point counts once, by its first byte
CONTINUED = bytes(range(128, 192))


def classes(text: bytes) -> np.ndarray:
    """How many code points of a text are in each class."""
    found = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=256)
    return found[: len(CLASSES)]


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words that lie in a window of ``run`` words found at two places or more."""
    n = len(words) - run + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    if len(number) > len(words) - run:  # too few repeated words for a repeated window
        return 0
    mix = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mix ^= mix >> np.uint64(29)
    key = np.zeros(n, np.uint64)
    for i in range(run):
        key = key * np.uint64(0xBF58476D1CE4E5B9) + mix[i : i + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    a, b = order[1:][same], order[:-1][same]
    steps = np.arange(run)
    if any((ids[a[i : i + PAIRS, None] + steps] != ids[b[i : i + PAIRS, None] + steps]).any()
           for i in range(0, len(a), PAIRS)):  # equal keys by chance
        seen = Counter(map(tuple, np.lib.stride_tricks.sliding_window_view(ids, run)))
        windows = np.lib.stride_tricks.sliding_window_view(ids, run)
        starts = np.array([i for i, w in enumerate(windows) if seen[tuple(w)] > 1], int)
    else:
        starts = np.unique(np.concatenate([a, b]))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + run, -1)
    return int((np.cumsum(change) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text.translate(None, CONTINUED + SPACE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def named(word: bytes) -> bytes:
    """The word, or for a long one a line break, which no word has, and a digest of the word."""
    return word if len(word) <= LONG else b"\n" + blake2b(word, digest_size=16).digest()


def count_words(text: bytes) -> Counter:
    """How often a text has each word, in lower case, under the name it has in references."""
    found = Counter(text.lower().split())
    for word in [w for w in found if len(w) > LONG]:
        found[named(word)] += found.pop(word)
    return found


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of histogram ``p`` from the rows of ``q`` (sums 1)."""
    p = p / max(p.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(-1)
    return np.sqrt(np.maximum((a + b) / 2, 0.0))


@dataclass
class References:
    """Per language: shares of classes, common words and their shares (the rest last)."""

    names: list[str | None] = field(default_factory=list)
    classes: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CLASSES))))
    words: list[dict[bytes, int]] = field(default_factory=list)
    shares: list[np.ndarray] = field(default_factory=list)


def language_references(
    docs: DataFrame, *, common: int = 40, least_docs: int = 20, held: int = 32 << 20
) -> References:
    """References of all languages, each from all its documents.

    All words of all texts are counted; a task hands its counts on when they take ``held`` bytes.
    A null language is a language of its own.  Languages with fewer than ``least_docs``
    documents have no reference; if no language has more, all have one.  Null and empty texts
    count as documents without words, repeated rows each time; equal counts of words are ordered
    by the words, those of more than ``LONG`` bytes by their digests.  An empty table gives no
    references.
    """
    ship(docs.sparkSession)

    def handed_on(words, sums):
        out = [(lang, named(w), float(n)) for lang, c in words.items() for w, n in c.items()]
        out += [(lang, b" %d" % i, float(v)) for lang, t in sums.items() for i, v in enumerate(t)]
        for i in range(0, len(out), 50_000):
            lang, key, n = zip(*out[i : i + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(key, pa.binary()),
                 pa.array(n, pa.float64())], ["lang", "word", "n"])

    def counts(batches):
        words: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}
        for batch in parts(batches, "text"):
            for lang, text in zip(batch.column(0).to_pylist(), byte_texts(batch, "text")):
                found = words.setdefault(lang, Counter())
                total = sums.setdefault(lang, np.zeros(len(CLASSES) + 3))
                split = text.lower().split()
                found.update(split)
                if split:
                    found_here = classes(text)
                    total[: len(CLASSES)] += np.log(found_here / found_here.sum() + LITTLE)
                    total[-3:] += len(split), 1, 1
                else:
                    total[-1] += 1
            if sum(ENTRY * len(c) + sum(map(len, c)) for c in words.values()) >= held:
                yield from handed_on(words, {})
                words.clear()
        yield from handed_on(words, sums)
        words.clear()
        give_back()

    table = (
        docs.selectExpr("CAST(lang AS STRING) AS lang", "CAST(text AS STRING) AS text")
        .mapInArrow(counts, "lang string, word binary, n double")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    # keys of sums begin with a space, which no word has; the last sum counts documents
    top = Window.partitionBy("lang", F.substring("word", 1, 1) == F.lit(b" ")).orderBy(
        F.col("n").desc(), "word")
    table = stored(table.withColumn("rank", F.row_number().over(top)).where(
        F.col("rank") <= max(common, len(CLASSES) + 3)), "language-words")
    sizes = table.where(F.col("word") == F.lit(b" %d" % (len(CLASSES) + 2))).select(
        F.col("lang").alias("of"), F.col("n").alias("n_docs"))
    enough = sizes.where(F.col("n_docs") >= least_docs)
    if not enough.limit(1).count():
        enough = sizes
    kept = table.join(F.broadcast(enough), F.col("lang").eqNullSafe(F.col("of")), "left_semi")
    rows = kept.select("lang", "word", "n", "rank").toPandas()  # 40 words of each that is large
    found = []
    for lang, part in rows.groupby("lang", dropna=False, sort=False):
        is_sum = part.word.map(lambda w: bytes(w).startswith(b" "))
        sums = {int(bytes(w)): n for w, n in zip(part.word[is_sum], part.n[is_sum])}
        ours = part[~is_sum].sort_values("rank").head(common)
        total = np.array([sums[i] for i in range(len(CLASSES) + 3)])
        found.append((total, [bytes(w) for w in ours.word], ours.n.to_numpy(float),
                      None if pd.isna(lang) else lang))
    found.sort(key=lambda f: (-f[0][-1], f[3] is None, f[3] or ""))
    refs = References()
    for total, words, n, lang in found:
        refs.names.append(lang)
        share = np.maximum(np.exp(total[: len(CLASSES)] / max(total[-2], 1)) - LITTLE, 0.0)
        refs.classes = np.vstack([refs.classes, share / max(share.sum(), 1e-9)])
        refs.words.append({w: i for i, w in enumerate(words)})
        rest = max(total[-3] - n.sum(), 0.0)
        refs.shares.append(np.append(n, rest) / max(n.sum() + rest, 1.0))
    return refs


@dataclass
class Rules:
    """Limits of ``judge``."""

    most_classes: float = 0.2
    most_words: float = 0.4
    least_chars: int = 100
    least_words: int = 60

    def apply(self, text: bytes, lang: str | None, refs: References):
        """Base counts, whether they fail, both distances (or None), whether to keep."""
        words = text.split()
        base = base_counts(text, words)
        n = base[0]
        failed = n < 20 or 100 * base[4] > 30 * n
        by_class = by_word = None
        compared = lang in refs.names
        if compared and base[1] >= self.least_chars:
            by_class = float(distance(classes(text).astype(float), refs.classes).min())
        if compared and n >= self.least_words:
            seen = count_words(text)
            by_word = 1.0
            for index, share in zip(refs.words, refs.shares):
                p = np.array([seen[w] for w in index] + [0.0])
                p[-1] = n - p.sum()
                by_word = min(by_word, float(distance(p, share)))
        near = (by_class or 0.0) <= self.most_classes and (by_word or 0.0) <= self.most_words
        return (*base, failed, by_class, by_word, near and not failed)


def judge(docs: DataFrame, refs: References, rules: Rules = Rules()) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, both distances, ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated windows.  A document
    is kept if its base did not fail and its distances from the nearest reference are at most
    ``most_classes`` and ``most_words``.  Texts with fewer than ``least_chars`` visible code
    points or ``least_words`` words are not held against the first or second histogram, those
    of a language without a reference against neither.

    A null text has no words and fails.  Repeated rows are judged row by row, null ids kept,
    other columns ignored; an empty table gives an empty result.  No shuffle.
    """
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(refs)  # 40 words of each language that is large
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def rows(batches):
        for batch in parts(batches, "text"):
            found = list(zip(*(
                rules.apply(t, lang, shared.value)
                for t, lang in zip(byte_texts(batch, "text"), batch.column("lang").to_pylist()))))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))],
                ["doc_id", *names, "base_failed", "class_distance", "word_distance", "kept"])

    return docs.selectExpr(
        "doc_id", "CAST(text AS STRING) AS text", "CAST(lang AS STRING) AS lang").mapInArrow(
        rows, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
        + ", base_failed boolean, class_distance double, word_distance double, kept boolean")


def keep_good(docs: DataFrame, refs: References, rules: Rules = Rules()) -> DataFrame:
    """The rows, with all their columns, that ``judge`` keeps.

    Null texts fail, null and small languages are treated as ``judge`` says, repeated rows are
    judged row by row, columns may have any name; an empty table gives an empty result."""
    lang, = unlike(docs.columns, "lang_as_text")
    shared = ship(docs.sparkSession).sparkContext.broadcast(refs)

    def rows(batches):
        for batch in parts(batches, "text"):
            langs = batch.column(batch.num_columns - 1).to_pylist()
            stay = [rules.apply(t, lang, shared.value)[-1]
                    for t, lang in zip(byte_texts(batch, "text"), langs)]
            yield batch.select(docs_columns).filter(pa.array(stay, pa.bool_()))
        give_back()

    docs_columns = list(range(len(docs.columns)))
    return docs.withColumn(lang, F.col("lang").cast("string")).mapInArrow(rows, docs.schema)
