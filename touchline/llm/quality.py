"""Quality rules: plain counts and tokeniser fertility.

Public vocabularies measure each text: characters per token, the share of byte-fallback
tokens and the entropy of its tokens, by a piece vocabulary and, where its ranks are given,
by a byte-level one of many languages (whose byte fallback is tokens of one byte of a
longer character).  What is usual differs between languages, so the bands are fitted per
language (per script where the language is null) over all documents: median plus or minus
``WIDTH`` robust deviations.  A text outside a band is rejected, as is one that fails the
plain rules (too few words, mostly repeated word windows).
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import materialise, texts_of, with_arrow_columns

MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = "#*$%&|<>"
#: Bands reach this many robust deviations (1.4826 times the median absolute deviation) from the median.
WIDTH = 5.0
#: Least deviation of a band, as texts of one language may hardly differ.
FLOOR = {"chars_per_token": 0.03, "byte_share": 0.01, "entropy": 0.02}
#: Bytes that a worker's table of encoded words may take (words, ids and the table itself), and the longest word in it.
REMEMBERED_BYTES, LONG_WORD = 64 << 20, 48
_ENTRY = 250  # bytes of an entry besides its characters and ids
SCRIPTS = {"latin": "A-Za-zÀ-ɏ", "greek": "Ͱ-Ͽ", "cyrillic": "Ѐ-ӿ", "hebrew": "֐-׿", "arabic": "؀-ۿ",
           "devanagari": "ऀ-ॿ", "hangul": "가-힯", "kana": "぀-ヿ", "han": "一-鿿"}


def words_of(text: str) -> list[str]:
    """Runs of characters between ASCII white space (bytes split there and nowhere else)."""
    return [w.decode() for w in text.encode().split()]


def plain_counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words."""
    n = len(words)
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.encode().split()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        again = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=n - 2)
        covered = np.zeros(n, dtype=bool)
        for k in range(WINDOW):
            covered[k:n - 2 + k] |= again
        repeated = int(covered.sum())
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated


class Fertility:
    """Tokens per text from one vocabulary, word by word.

    What a word gives is kept, as words repeat heavily, in a table bounded by bytes; long words
    (unspaced scripts) are not kept beyond the texts at hand.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], is_byte: np.ndarray):
        self.encode, self.is_byte = encode, is_byte
        self.known: dict[str, bytes] = {}
        self.size = 0
        self.passing: list[str] = []  # long words of the texts at hand

    def tables(self, words: set[str]) -> Callable[[str], bytes]:
        """A look-up for ``words``: the ids of each, four bytes an id.  It holds until the next call."""
        for word in self.passing:
            del self.known[word]
        self.passing = []
        if self.size > REMEMBERED_BYTES:
            self.known, self.size = {}, 0
        new = [w for w in words if w not in self.known]
        short = [w for w in new if len(w) <= LONG_WORD]
        for word, found in zip(short, self.encode(short)):
            self.known[word] = found
            self.size += _ENTRY + 4 * len(word) + len(found)
        self.passing = [w for w in new if len(w) > LONG_WORD]
        for word in self.passing:  # one at a time: a list of ids takes ten times the bytes
            self.known[word] = next(iter(self.encode([word])))
        return self.known.__getitem__

    def measure(self, words: list[str], ids_of: Callable[[str], bytes]) -> tuple[int, float, float]:
        """Tokens, share of byte tokens, and entropy in bits over its greatest possible value."""
        ids = np.frombuffer(b"".join(map(ids_of, words)), dtype="<u4")
        if not len(ids):
            return 0, 0.0, 0.0
        if len(ids) < 1 << 13:  # few against the vocabulary
            at, counts = np.unique(ids, return_counts=True)
        else:
            counts = np.bincount(ids)
            at = np.flatnonzero(counts)
            counts = counts[at]
        share = counts / len(ids)
        entropy = float(-(share * np.log2(share)).sum())
        return len(ids), float(share[self.is_byte[at]].sum()), entropy / max(1.0, np.log2(len(ids)))


def piece_fertility(model: bytes) -> Fertility:
    """By a sentencepiece model with byte fallback."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    return Fertility(lambda words: (_packed(ids) for ids in pieces.encode(words, num_threads=1)), is_byte)


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_fertility(ranks: dict[bytes, int], pattern: str) -> Fertility:
    """By byte-level ranks; a word is read with the blank before it, as in running text."""
    import tiktoken

    coder = tiktoken.Encoding("fertility", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    is_byte = np.zeros(max(ranks.values()) + 1, dtype=bool)
    is_byte[[r for token, r in ranks.items() if len(token) == 1 and token[0] > 127]] = True
    opens = np.zeros(len(is_byte), dtype=bool)  # tokens that begin with a blank
    opens[[r for token, r in ranks.items() if token[:1] == b" "]] = True
    runs = r" ?\p{L}+" in pattern.split("|")  # letters with the blank before them are one match, wherever they stand

    def encode(words: list[str]) -> Iterable[bytes]:
        plain = [w for w in words if runs and w.isalpha()]
        found = {}
        if plain:  # all at once: each begins with the one token that has its blank
            ids = np.array(coder.encode_ordinary(" " + " ".join(plain)), dtype="<u4")
            cuts = np.append(np.flatnonzero(opens[ids]), len(ids)) * 4
            buffer = ids.tobytes()
            found = {w: buffer[i:j] for w, i, j in zip(plain, cuts.tolist(), cuts[1:].tolist())}
        return [found[w] if w in found else _packed(coder.encode_ordinary(" " + w)) for w in words]

    return Fertility(encode, is_byte)


SECOND = "_bytes"  # ending of the second vocabulary's measures


def measures(second: bool) -> dict[str, float]:
    """Measure -> least deviation of its band."""
    return FLOOR | ({f"{m}{SECOND}": v for m, v in FLOOR.items()} if second else {})


def feature_table(docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id", lang: str = "lang",
                  ranks: dict[bytes, int] | None = None, pattern: str | None = None) -> DataFrame:
    """(key, lang_group, counts, n_tokens, measures) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model, ranks, pattern))  # vocabularies: their size does not follow the data
    made: list[Fertility] = []
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = [T.StructField(n, T.LongType()) for n in (*names, "n_tokens")]
    fields += [T.StructField(n, T.DoubleType()) for n in measures(ranks is not None)]

    def compute(batch: pa.RecordBatch) -> list:
        if not made:
            given, given_ranks, split = shared.value
            made.extend([piece_fertility(given)] + ([byte_fertility(given_ranks, split)] if given_ranks else []))
        rows, texts = [], texts_of(batch, text)
        for at in range(0, len(texts), 256):
            words = [words_of(t) for t in texts[at:at + 256]]
            every = set().union(*words)
            found = [(f, f.tables(every)) for f in made]
            for value, own in zip(texts[at:at + 256], words):
                counts = plain_counts(value, own)
                row, tokens = list(counts), []
                for fertility, ids_of in found:
                    n, byte_share, entropy = fertility.measure(own, ids_of)
                    tokens.append(n)
                    row += [counts[1] / n if n else 0.0, byte_share, entropy]
                row.insert(len(counts), tokens[0])
                rows.append(row)
        return list(zip(*rows))

    script = script_of(F.col(text))
    keyed = docs.select(key, text, F.coalesce(F.col(lang).cast("string"), F.concat(F.lit("script:"), script)).alias("lang_group"))
    return with_arrow_columns(keyed, fields, compute, keep=[key, "lang_group"])


def script_of(text: Column) -> Column:
    """Name of the script most frequent among the first letters of a text's words; ``none`` without any."""
    counts = [F.struct(F.regexp_count(text, F.lit(f"(?<![{r}])[{r}]")).alias("n"), F.lit(n).alias("script"))
              for n, r in SCRIPTS.items()]
    most = F.greatest(*counts)
    return F.when(most["n"] > 0, most["script"]).otherwise("none")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(REPEAT_PERCENT) * F.col("n_words"))


def fit_bands(features: DataFrame) -> DataFrame:
    """(lang_group, <measure>_mid, <measure>_dev ...): one row per language, over all texts that pass the plain rules.

    Medians come from mergeable summaries (relative rank error 1/10,000), so a language
    with a third of all rows is summed up per task.
    """
    fine = features.where(~base_failed())
    found = [m for m in measures(True) if m in features.columns]
    mid = fine.groupBy("lang_group").agg(*[F.percentile_approx(m, 0.5, 10_000).alias(f"{m}_mid") for m in found])
    off = fine.join(F.broadcast(mid), "lang_group")  # one row per language
    return mid.join(off.groupBy("lang_group").agg(
        *[F.percentile_approx(F.abs(F.col(m) - F.col(f"{m}_mid")), 0.5, 10_000).alias(f"{m}_dev") for m in found]), "lang_group")


def judge(features: DataFrame, bands: DataFrame, width: float = WIDTH) -> DataFrame:
    """``features`` with base_failed and kept; languages without a band reject nothing."""
    placed = features.join(F.broadcast(bands), "lang_group", "left")
    inside = F.lit(True)
    for m, least in ((m, v) for m, v in measures(True).items() if m in features.columns):
        reach = width * F.greatest(1.4826 * F.col(f"{m}_dev"), F.lit(least))
        gap = F.col(m) - F.col(f"{m}_mid")
        outside = (gap > reach) if m.startswith("byte_share") else F.abs(gap) > reach
        inside = inside & ~F.coalesce(outside, F.lit(False))
    return (placed.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & inside))


def quality_table(docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id", lang: str = "lang",
                  ranks: dict[bytes, int] | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: plain counts, base_failed, kept, and the fertility measures.

    ``model`` is a serialised sentencepiece model; ``ranks`` and ``pattern``, if given, a second
    vocabulary, byte-level, with measures and bands of its own.

    Null and empty texts have no words and fail the plain rules.  A null language is
    judged by its script.  Repeated rows give repeated rows, null keys pass through, an
    empty table gives an empty result; columns besides key, text and lang are not read.
    """
    features = materialise(feature_table(docs, model, text, key, lang, ranks, pattern), "quality_features")
    bands = materialise(fit_bands(features), "quality_bands")
    out = judge(features, bands)
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "n_tokens", *measures(ranks is not None))
