"""Language identification by cross-parsing entropy.

A suffix automaton is built over whole labelled texts of each language, from a bounded
number of rows.  A text is parsed greedily into the longest phrases that occur in a
language's sample; the number of phrases, times the bits that name a phrase, per character,
estimates the cross entropy.  The language that needs fewest normalised phrases wins.

Texts are parsed whole.  So that long ones load the workers evenly, a text is cut into
stretches that are parsed side by side, each from its first character; then every
stretch is parsed again from the state that the one before it ends in, until a phrase
starts where one had started before.  That is the parse of the whole text: no
phrase ends because a stretch does.  All stretches of a group of texts take one step at a time
as a NumPy operation.
"""

from __future__ import annotations

import math
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import crc_fold, texts_of, with_arrow_columns

#: Bound of the sample: documents per language, learned from whole; those of a length (characters) within these are taken first.
SAMPLE_DOCS, USUAL_CHARS = 24, (400, 20_000)
#: Bytes that the automata of all languages may take in a worker.
MOST_BYTES = 256 << 20
STRETCH = 512  # characters that are parsed side by side
_GROUP = 3_000_000  # characters parsed together
_UNSEEN, _BORDER, _OTHER = 0, 1, 2  # codes of letters that no sample has, of text borders (samples only), of all but letters
_ROOT, _LITERAL = 1, 2  # states: the empty phrase, and a single character that no sample of the language has


@cache
def _folded() -> np.ndarray:
    """Code point -> code point of its lower case if it is a letter, else 0."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            out[cp] = ord(low[0])
    return out


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def make_alphabet(texts: list[str]) -> tuple[np.ndarray, int]:
    """Code point -> code, and the number of codes: every letter of the texts has a code of its own, whatever its case."""
    folded = _folded()
    letters = np.unique(folded[_points(texts)])
    letters = letters[letters > 0]
    code = np.zeros(0x110000, dtype=np.int32)
    code[letters] = np.arange(_OTHER + 1, _OTHER + 1 + len(letters))
    code[0] = _OTHER
    return code[folded], _OTHER + 1 + len(letters)


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``, by state; states 0 and _LITERAL have none."""
    link, length, nexts = [0, -1, -1], [0, 0, 0], [{}, {}, {}]
    last = _ROOT
    for c in codes:
        now = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(_ROOT)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = now
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    return nexts


class Transitions:
    """The edges of an automaton in one array: that of (state, code) lies at base[state] + code, if it names that state.

    The states' rows are shifted over each other until they fit (those with several edges in
    turn, those with one wherever a place is free), so the array is little longer than the edges.
    """

    def __init__(self, nexts: list[dict[int, int]], codes: int):
        if len(nexts) >= 1 << 24:
            raise ValueError("too long a sample for one table")
        self.root = np.full(codes, _LITERAL, dtype=np.int64)
        for c, t in nexts[_ROOT].items():
            self.root[c] = t
        self.base = np.zeros(len(nexts), dtype=np.int64)
        edges = sum(map(len, nexts)) - len(nexts[_ROOT])
        slots = np.full(edges + 4 * codes + 1024, -1, dtype=np.int64)  # state above 24 bits of next state
        many = sorted((s for s, out in enumerate(nexts) if len(out) > 1 and s != _ROOT), key=lambda s: -len(nexts[s]))
        from_ = 0
        for s in many:
            own = np.array(sorted(nexts[s]), dtype=np.int64)
            while True:
                if from_ + 256 + codes > len(slots):
                    slots = np.append(slots, np.full(len(slots), -1, dtype=np.int64))
                fits = (slots[np.arange(from_, from_ + 256)[:, None] + own] == -1).all(axis=1)
                if fits.any():
                    break
                from_ += 256
            from_ += int(fits.argmax())
            self.base[s] = from_
            slots[from_ + own] = s << 24 | np.array([nexts[s][c] for c in own.tolist()], dtype=np.int64)
        single = [s for s, out in enumerate(nexts) if len(out) == 1 and s != _ROOT]
        if single:
            code, to = np.array([next(iter(nexts[s].items())) for s in single], dtype=np.int64).T
            free = np.flatnonzero(slots[codes:] == -1) + codes
            if len(free) < len(single):
                extra = np.arange(len(slots), len(slots) + len(single) - len(free))
                slots, free = np.append(slots, np.full(len(extra), -1, dtype=np.int64)), np.append(free, extra)
            free = free[:len(single)]
            slots[free] = np.array(single, dtype=np.int64) << 24 | to
            self.base[single] = free - code
        used = np.flatnonzero(slots != -1)
        self.slots = np.append(slots[:used[-1] + 1 if len(used) else 0], np.full(codes, -1, dtype=np.int64))

    def size(self) -> int:
        return self.slots.nbytes + self.base.nbytes + self.root.nbytes

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether each begins a phrase: the one before could not go on, or the state was the root."""
        edge = self.slots[self.base[state] + code]
        fresh = edge >> 24 != state
        return np.where(fresh, self.root[code], edge & 0xFFFFFF), fresh


class CrossParser:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.alphabet, codes = make_alphabet([t for lang in self.languages for t in samples[lang]])
        self.tables: list[Transitions] = []
        self.bits = []
        for lang in self.languages:
            sample = [c for t in samples[lang] for c in [*self.alphabet[_points([t])].tolist(), _BORDER]]
            self.tables.append(Transitions(suffix_automaton(sample), codes))
            self.bits.append(math.log2(len(sample) + 1))
            if sum(t.size() for t in self.tables) > MOST_BYTES:
                raise ValueError(f"the automata take over {MOST_BYTES} bytes in each worker: learn from fewer documents a language")

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): phrases that each text parses into.  No text may be empty."""
        codes = self.alphabet[_points(texts)].astype(np.int64)
        size = np.array([len(t) for t in texts])
        text_end = np.cumsum(size)
        lanes = -(-size // STRETCH)
        owner = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = (text_end - size)[owner] + nth * STRETCH
        stop = np.minimum(begin + STRETCH, text_end[owner])
        out = np.empty((len(texts), len(self.tables)), dtype=np.int64)
        for k, table in enumerate(self.tables):
            starts = _parse(table, codes, begin, stop, nth > 0)
            out[:, k] = np.add.reduceat(starts, text_end - size, dtype=np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Best language and score of each text: 1 - best entropy / second best, 1 with one language.

        ``und`` and 0 for a text without a letter, or without any learned language.
        """
        best, score = ["und"] * len(texts), [0.0] * len(texts)
        lettered = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if self.languages else []
        at = 0
        while at < len(lettered):
            end, chars = at, 0
            while end < len(lettered) and (end == at or chars + len(texts[lettered[end]]) <= _GROUP):
                chars += len(texts[lettered[end]])
                end += 1
            group = lettered[at:end]
            entropy = self.phrases([texts[i] for i in group]) * self.bits / np.array([[len(texts[i])] for i in group])
            order = np.argsort(entropy, axis=1, kind="stable")
            for i, row, rank in zip(group, entropy, order):
                best[i] = self.languages[rank[0]]
                score[i] = float(1 - row[rank[0]] / row[rank[1]]) if len(rank) > 1 else 1.0
            at = end
        return best, score


def _parse(table: Transitions, codes: np.ndarray, begin: np.ndarray, stop: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """1 where a phrase of the greedy parse starts, for each character.

    Stretches are [begin, stop); ``goes_on`` marks those that follow another one of their text.
    """
    starts = np.zeros(len(codes), dtype=np.uint8)
    entry = np.full(len(begin), _ROOT, dtype=np.int64)  # the state that each stretch was entered with
    leave = entry.copy()
    by = np.argsort(begin - stop, kind="stable")  # the longest first, so that those that go on are always the first ones
    first, ends = begin[by], (stop - begin)[by]
    state = entry.copy()
    for i in range(int(ends[0])):
        n = int(np.searchsorted(-ends, -i, side="left"))  # those longer than i
        at = first[:n] + i
        state[:n], fresh = table.step(state[:n], codes[at])
        starts[at] = fresh
    leave[by] = state
    follows = np.flatnonzero(goes_on)
    while True:
        wrong = follows[leave[follows - 1] != entry[follows]]
        if not len(wrong):
            return starts
        entry[wrong] = leave[wrong - 1]
        _advance(table, codes, starts, wrong, begin, stop, entry, leave)


def _advance(table: Transitions, codes: np.ndarray, starts: np.ndarray, lanes: np.ndarray, begin: np.ndarray, stop: np.ndarray,
             entry: np.ndarray, leave: np.ndarray) -> None:
    """Parse the stretches ``lanes`` from their entry states, marking phrase starts, and note the states that they end in.

    A lane ends early where a phrase starts that was marked before: all after that stays.
    """
    at, state, end = begin[lanes], entry[lanes], stop[lanes]
    while len(lanes):
        state, fresh = table.step(state, codes[at])
        met = fresh & (starts[at] == 1)
        starts[at] = fresh
        at = at + 1
        done = at == end
        if done.any() or met.any():
            left = done & ~met
            leave[lanes[left]] = state[left]
            going = ~(done | met)
            lanes, at, state, end = lanes[going], at[going], state[going], end[going]


def training_sample(docs: DataFrame, learn, text: str, key: str, lang: str, n_docs: int, usual: tuple[int, int]) -> dict[str, list[str]]:
    """Up to ``n_docs`` whole texts per language, from rows where ``learn`` holds.

    The documents are those of least key hash that have a letter and a usual length (others
    only where too few have).  Bounded per language before anything is gathered.
    """
    short = (~F.length(text).between(*usual)).cast("int")
    rows = docs.where(learn & F.col(lang).isNotNull() & F.coalesce(F.regexp_like(text, F.lit("\\p{L}")), F.lit(False)))
    order = Window.partitionBy("lang").orderBy("short", "mix", "key")
    rows = rows.select(F.col(lang).cast("string").alias("lang"), short.alias("short"), F.xxhash64(F.lit(11), key).alias("mix"),
                       F.col(key).alias("key"))
    first = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= n_docs)  # cut per task first
    first = first.select(F.col("key").alias("chosen"), F.col("lang").alias("chosen_lang")).distinct()
    found = docs.join(F.broadcast(first), (docs[key] == F.col("chosen")) & (docs[lang].cast("string") == F.col("chosen_lang")))
    rank = Window.partitionBy("lang").orderBy("key", "piece")
    found = found.select(F.col("chosen_lang").alias("lang"), F.col(key).alias("key"), F.col(text).alias("piece")).distinct()
    found = found.withColumn("at", F.row_number().over(rank)).where(F.col("at") <= n_docs)  # keys may repeat
    out: dict[str, list[str]] = {}
    for row in found.orderBy("lang", "at").collect():
        out.setdefault(row["lang"], []).append(row["piece"])
    return out


def language_table(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", folds: int = 4,
                   held: int = 2, n_docs: int = SAMPLE_DOCS, usual: tuple[int, int] = USUAL_CHARS) -> DataFrame:
    """(key, held_out, lang_pred, score) of each whole text.

    Learns from rows with a language whose crc32(key as text) mod ``folds`` is not ``held``;
    rows with a null key are neither learned from nor held out.  Predictions read the text
    alone.  A null text, or one without a letter, gives ``und`` and 0; so does every text if
    nothing could be learned.  Repeated rows give repeated rows; an empty table gives an
    empty result.
    """
    fold = crc_fold(F.col(key), folds)
    samples = training_sample(docs, fold != held, text, key, lang, n_docs, usual)
    shared = docs.sparkSession.sparkContext.broadcast(CrossParser(samples))  # bounded by the sample
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def compute(batch: pa.RecordBatch) -> list:
        return list(shared.value.predict(texts_of(batch, text)))

    rows = docs.select(key, text, F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    return with_arrow_columns(rows, fields, compute, keep=[key, "held_out"])


