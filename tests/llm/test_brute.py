"""Quality and toxicity against plain versions of every step; memory of the word tables."""

import math
import random
import re
import statistics
import tracemalloc
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.llm import bpe, quality, queries, toxicity

SF = "/root/testdata/sf0.001"


# --- quality ---------------------------------------------------------------------------------------------------

def plain_measures(ids, byte_ids, chars):
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    shares = [c / n for c in Counter(ids).values()]
    entropy = -sum(s * math.log2(s) for s in shares) / max(1.0, math.log2(n))
    return n, chars / n, sum(i in byte_ids for i in ids) / n, entropy


def plain_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return words, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def test_quality_like_plain_steps(spark):
    import public_tokenizers
    import sentencepiece
    import tiktoken

    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary(queries.PIECES))
    piece_bytes = {i for i in range(pieces.get_piece_size()) if pieces.is_byte(i)}
    ranks = bpe.read_ranks(queries.vocabulary(queries.MANY_RANKS))
    coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rank_bytes = {r for t, r in ranks.items() if len(t) == 1 and t[0] > 127}
    rows, fine = {}, {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words, *counts = plain_counts(r["text"] or "")
        n, *first = plain_measures([i for w in words for i in pieces.encode(w)], piece_bytes, counts[1])
        _, *second = plain_measures([i for w in words for i in coder.encode_ordinary(" " + w)], rank_bytes, counts[1])
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        rows[r["doc_id"]] = (r["lang"], tuple(counts), failed, n, (*first, *second))
        if not failed:
            fine.setdefault(r["lang"], []).append((*first, *second))
    middles = {lang: [statistics.median_low(v) for v in zip(*own)] for lang, own in fine.items()}
    spreads = {lang: [statistics.median_low(abs(x - m) for x in v) for v, m in zip(zip(*own), middles[lang])] for lang, own in fine.items()}
    out = {r["doc_id"]: r for r in queries.op4_quality(spark, SF).collect()}
    assert out.keys() == rows.keys() and any(r["kept"] for r in out.values())
    names = list(quality.measures(True))
    for doc_id, (lang, counts, failed, n, found) in rows.items():
        r = out[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == failed and r["n_tokens"] == n
        assert [r[m] for m in names] == pytest.approx(list(found), abs=1e-12)
        inside = True
        for m, value, middle, spread, least in zip(names, found, middles.get(lang, found), spreads.get(lang, found), quality.measures(True).values()):
            gap, reach = value - middle, 5.0 * max(1.4826 * spread, least)
            if lang in middles and (gap > reach if m.startswith("byte") else abs(gap) > reach):
                inside = False
        assert r["kept"] == (not failed and inside), doc_id


def unspaced(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(chr(rnd.randrange(0x4e00, 0x9fa5)) for _ in range(400)) for _ in range(n))


def test_word_tables_are_bounded_by_bytes():
    import public_tokenizers

    with open(queries.vocabulary(queries.PIECES), "rb") as f:
        pieces = quality.piece_fertility(f.read())
    ranks = bpe.read_ranks(queries.vocabulary(queries.RANKS))
    coder = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    tracemalloc.start()
    for k in range(5):
        words = quality.words_of(unspaced(250, k))
        assert pieces.measure(words, pieces.tables(set(words)))[0] > 0
        list(coder.encode_texts([unspaced(100, k)]))
    for k in range(4):
        short = [f"{k}x{i:06x}" for i in range(60_000)]
        pieces.tables(set(short))
        list(coder.encode_texts([" ".join(short)]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 200 << 20
    pieces.tables(set())
    assert not any(len(w) > quality.LONG_WORD for w in pieces.known) and not any(len(c) > bpe.LONG_CUT for c in (*coder.known, *coder.older))


# --- toxicity --------------------------------------------------------------------------------------------------

def plain_features(text, lexicon):
    raw = re.findall(r"[^\W_]+", text)
    if not raw:
        return dict.fromkeys(toxicity.FEATURES, 0.0)
    words, hits, odds, obfuscated = [w.lower() for w in raw], [], {}, 0
    for i, w in enumerate(words):
        plain = w
        for a, b in zip("013457@$", "oieastas"):
            plain = plain.replace(a, b)
        if w not in lexicon.words and not w.isalpha() and plain in lexicon.words:
            obfuscated, w = obfuscated + 1, plain
        if w in lexicon.words:
            hits.append(i)
            odds[i] = (w, lexicon.words[w])
    stems = [lexicon.stems[w[:4]] for w in words if len(w) > 4 and w[:4] in lexicon.stems]
    you = [i for i, w in enumerate(words) if w in toxicity.YOU]
    n = len(words)
    capital = sum(c.isalpha() for c in text) if text.isupper() else sum("A" <= c <= "Z" or "À" <= c <= "Ö" or "Ø" <= c <= "Þ" for c in text)
    return dict(hits=len(hits), hit_rate=100 * len(hits) / n, strength=sum(o for _, o in odds.values()), top_odds=max([0.0, *(o for _, o in odds.values())]),
                distinct_hits=len({w for w, _ in odds.values()}), stem_hits=len(stems), stem_rate=100 * len(stems) / n, stem_strength=sum(stems),
                you_rate=100 * len(you) / n, you_near=sum(any(abs(i - j) <= 6 for j in you) for i in hits) / max(1, len(hits)),
                caps=capital / len(text), caps_words=sum(len(w) > 1 and w.isupper() for w in raw) / n, exclaim=100 * text.count("!") / n,
                punct=sum(c in ".,;:!?*#$%&|" for c in text) / n, obfuscated=None, log_words=math.log(n), plain_obfuscated=obfuscated)


def test_features_like_plain_ones():
    rnd = random.Random(9)
    lexicon = toxicity.Lexicon({"fool": 2.5, "idiot": 3.0, "trash": 1.5}, {"idio": 2.0, "stup": 1.8})
    bits = ["fool", "FOOL", "f00l", "idiot", "1d10t", "stupid", "stuporous", "you", "your", "vous", "a", "Word", "ÉCOLE", "été", "x_y", "!", "!!", "...", "#", "42",
            "TRASH", "tr4sh", "\n", "é"]
    for _ in range(3000):
        text = " ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30)))
        text = text.upper() if rnd.random() < 0.1 else text
        got, expected = dict(zip(toxicity.FEATURES, toxicity.features_of(text, lexicon))), plain_features(text, lexicon)
        n = len(re.findall(r"[^\W_]+", text))
        if n:  # disguised letters, and single letters spelled apart, are counted besides words that read as an entry
            assert got["obfuscated"] * n >= expected.pop("plain_obfuscated") - 1e-9
            expected["obfuscated"] = got["obfuscated"]
        assert got == pytest.approx(expected), text


def test_lexicons_and_folds_like_plain_counts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    sample = toxicity.labelled_sample(docs, labels, 10_000, "text", "doc_id", "toxic").cache()
    rows = sample.collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    marked = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    assert {r["doc_id"]: (r["toxic"], r["text"]) for r in rows} == {i: (y, texts[i]) for i, y in marked.items()}
    lexicons = toxicity.learn_lexicons(sample)
    for left_out, lexicon in zip([0, 1, 2, None], lexicons):
        inside = [(r["toxic"], {w.lower() for w in re.findall(r"[^\W_]+", r["text"])}) for r in rows if r["fold"] != left_out]
        sizes = Counter(y for y, _ in inside)
        counts = {y: Counter(w for z, words in inside if z == y for w in words) for y in (0, 1)}
        expected = {}
        for w, p in counts[1].items():
            q = counts[0][w]
            odds = math.log((p + .5) / (sizes[1] - p + .5)) - math.log((q + .5) / (sizes[0] - q + .5))
            odds -= 2 * math.sqrt(sum(1 / (x + .5) for x in (p, sizes[1] - p, q, sizes[0] - q)))
            if p >= 3 and odds >= 1.3:
                expected[w] = odds
        assert len(expected) < toxicity.LEXICON and lexicon.words == pytest.approx(expected)


def test_calibration_like_plain_interpolation(spark):
    steps = ([0.1, 0.3, 0.3, 0.6, 0.9], [0.0, 0.0, 0.2, 0.2, 1.0])
    raws = [i / 50 for i in range(51)]
    got = spark.createDataFrame([(r,) for r in raws], "raw double").select("raw", toxicity._calibrated(F.col("raw"), steps).alias("score")).collect()
    for r in got:
        x = r["raw"]
        if x <= 0.1:
            v = 0.0
        elif x <= 0.3:
            v = 0.0
        elif x <= 0.6:
            v = 0.2
        else:
            v = min(1.0, 0.2 + (x - 0.6) / 0.3 * 0.8)
        assert r["score"] == pytest.approx(0.999 * v + 0.001 * x)


def test_texts_that_share_a_key_resolve_alike(spark):
    rows = [(i, f"text {i} of one author", "a") for i in range(30)] + [(5, f"another text {k}", "a") for k in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    chosen = set()
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[1][::-1])):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(5)
        sample = toxicity.labelled_sample(docs, labels, 1000, "text", "doc_id", "toxic").collect()
        assert len({r["doc_id"] for r in sample}) == len(sample)
        chosen.add(tuple(r["text"] for r in sample if r["doc_id"] == 5))
    assert len(chosen) == 1
