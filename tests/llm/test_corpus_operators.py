"""Divergence, spelling variants and repeated passages against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from counterfold.llm import divergence, suffixes, variants

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, word int"
BIG = 1 << 60


def table(spark, rows):
    """Rows of id, text, lang, source, with columns whose names operators use inside."""
    return spark.createDataFrame([(*r, 0, 1, 2) for r in rows], SCHEMA)


# ---- divergence


def corpus(seed=4, n=300):
    r = random.Random(seed)
    words = ["the", "of", "Été", "naïve", "中文", "stone", "river", "light", "rare", "Zoo", "x"]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words[: r.randint(3, len(words))]) + r.choice(["", ".", "9", "-a"])
                        for _ in range(r.randint(0, 40)))
        rows.append((i, text, r.choice(["en", "de", None, ""]), r.choice(["a", "b", "c", None, "ö"])))
    return rows + [(None, None, "en", "none"), (5, "", "xx", "lonely"), (5, "only once", "yy", "p"),
                   (6, "", "yy", "q"), (7, "The the THE " * 20_000, "en", "a")]


def test_divergence_equals_its_sql(spark):
    rows = corpus()
    docs = table(spark, rows)
    found = sorted(map(tuple, divergence.source_divergence(docs).select(
        "lang", "source", "part", "item", "value", "rank").collect()))
    pdf = docs.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", pdf)
    want = sorted(con.execute(divergence.SQL).fetchall())
    assert [(*x[:4], int(x[4]), int(x[5])) for x in want] == found
    assert {x[4] for x in found if x[0] == "yy" and x[2] == "pair"} == {0}
    assert divergence.source_divergence(table(spark, [])).count() == 0


def test_path_corrections_do_not_depend_on_the_batches(spark, monkeypatch):
    """A tree cut after every row, and combinations one node at a time, sum to the same."""
    r = np.random.default_rng(1)
    sources = list(range(1, 7))
    paths = sorted(
        tuple((s, int(r.integers(1, 4)) * 1000 + s, 100 + s) for s in sources if r.random() < 0.6)
        for _ in range(200))
    paths = [x for x in paths if x]
    rows = [("en", [i[0] for i in x], [i[1] for i in x], [i[2] for i in x], 1 + k % 3)
            for k, x in enumerate(paths)]

    def f(a, b):
        return (a - b) ** 2 // b

    want = defaultdict(int)
    for _, s, p, z, n in rows:
        for i in range(len(s)):
            for j in range(i):
                for a, b in ((i, j), (j, i)):
                    want[s[a], s[b]] += n * (f(p[a], p[b]) - f(p[a], z[b]) - f(z[a], p[b]) + f(z[a], z[b]))

    def summed(size):
        import pyarrow as pa
        names = ["lang", "place", "p", "zero", "n"]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names)
                   for i in range(0, len(rows), size)]
        total = defaultdict(int)
        for b in divergence._path_corrections(batches):
            for _, item, other, value in zip(*(c.to_pylist() for c in b.columns)):
                total[item, other] += value
        return dict(total)

    assert summed(1000) == dict(want) == summed(1) == summed(7)
    monkeypatch.setattr(divergence, "TOGETHER", 1)
    assert summed(1000) == dict(want)


# ---- spelling variants


def brute_words(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    words = brute_words(rows)
    friends = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in friends[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= 2 * n and best[1] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(friends[w]), words.get(form[w])))
    return sorted(out)


def spelled_corpus():
    r = random.Random(8)
    base = ["stone", "stones", "stoned", "river", "rivers", "driver", "Größe", "größer", "éclair",
            "eclair", "Àlpha", "àlpha", "lights", "slight", "nights", "abcde", "aaaaa", "aaaaaa",
            "a" * 3000, "a" * 3001, "tion×x", "naïvely"]
    rows = [(BIG + i if i % 2 else i, " ".join(
        r.choice(base[: r.randint(4, len(base))]) for _ in range(r.randint(0, 60))), "en", "s")
        for i in range(150)]
    return rows + [(None, "river rivers, RIVER", None, None), (3, None, "en", "s"), (3, "", "en", "s"),
                   (4, "stone " * 50_000, "en", "s"), (4, "stone", "en", "s"), (4, "stone", "en", "s")]


@pytest.mark.parametrize("room", [None, 24])
def test_variants_against_all_pairs(spark, monkeypatch, room):
    rows = spelled_corpus()
    if room:  # many leaves and blocks
        monkeypatch.setattr(variants, "room", lambda length: room)
        monkeypatch.setattr(variants, "BUCKET", 2)
    docs = table(spark, rows).repartition(3)
    found = sorted(tuple(x) for x in variants.spelling_variants(docs).select(
        "word", "form", "root", "n", "n_near", "form_n").collect())
    assert found == brute_variants(rows)
    if room is None:
        assert variants.spelling_variants(table(spark, [])).count() == 0


def test_near_pairs_of_many_anagrams():
    """Words with equal counts cannot be split by a tree; letter order still tells them apart."""
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(9)) for _ in range(300)})
    longer = sorted({"".join(r.choice("ab") for _ in range(10)) for _ in range(300)})
    for a, b in ((words, words), (words, longer)):
        found = {tuple(p) for p in variants.near_pairs(
            [w.encode() for w in a], [w.encode() for w in b]).tolist()}
        assert found == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if near(x, y)}


def test_masks_and_boxes_keep_all_near_words_and_few_others():
    """A mask tells letters that stand twice; one edit changes a bit a letter.  A row reaches
    just the boxes that it is near enough to."""
    of = lambda *words: variants.counts_of(variants.letters_of(list(words)))
    bits = lambda a, b: int(np.bitwise_count(
        variants.masks(of(a))[0] ^ variants.masks(of(b))[0]))
    assert bits(b"aabbc", b"abccc") == 3
    r = random.Random(8)
    letters = [chr(c).encode("latin-1") for c in variants.LETTERS]
    for _ in range(2000):
        word = [r.choice(letters[:4] + letters[-30:]) for _ in range(6)]
        at, letter = r.randrange(6), r.choice(letters)
        other = word[:at] + [letter] + word[at + 1 :]
        longer = word[:at] + [letter] + word[at:]
        assert bits(b"".join(word), b"".join(other)) <= 2
        assert bits(b"".join(word), b"".join(longer)) <= 1
    points = of(*(bytes(r.choices(b"abcd", k=6)) for _ in range(300)))
    rows = of(*(bytes(r.choices(b"abcde", k=6)) for _ in range(100)))
    tree = variants.grow(points, 5)
    for more, less in ((0, 0), (1, 0), (1, 1)):
        found, want, stack = set(), set(), [tree]
        for node, at in variants.visits(tree, rows, more, less):
            found |= {(id(node), i) for i in at.tolist()}
        while stack:
            node = stack.pop()
            if node.split is not None:
                stack += [node.left, node.right]
                continue
            for i, c in enumerate(rows.astype(int)):
                lack = sum(max(b - c[k], 0) for k, b in node.low.items())
                over = sum(max(c[k] - b, 0) for k, b in node.high.items())
                if lack <= more and over <= less:
                    want.add((id(node), i))
        assert found == want and want


def test_forms_cannot_go_round(spark):
    with pytest.raises(ValueError):
        variants.spelling_variants(table(spark, []), ratio=1)


# ---- repeated passages


def order(doc):
    return (doc is None, 0 if doc is None else doc)


def brute_repeats(rows, least):
    first = {}
    for doc, text, *_ in rows:
        text = (text or "").encode()
        for i in range(len(text) - least + 1):
            w = text[i : i + least]
            first[w] = min(first.get(w, order(doc)), order(doc))
    out = []
    for doc, text, *_ in rows:
        text = (text or "").encode()
        gone = bytearray(len(text))
        for i in range(len(text) - least + 1):
            if first[text[i : i + least]] < order(doc):
                gone[i : i + least] = b"\1" * least
        runs = re.findall(b"\1+", bytes(gone))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((order(doc), len(text), sum(gone), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def results(df):
    return sorted((order(r.doc_id), r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans),
                   hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def repeating():
    r = random.Random(5)

    def text(n):
        return "".join(r.choice("abcdef ") for _ in range(n))

    passages = [text(k) for k in (49, 50, 51, 70, 120, 300, 1000)]
    rows = [(BIG + i, "".join(text(r.randint(0, 80)) + (r.choice(passages) if r.random() < 0.7 else "")
                              for _ in range(r.randint(0, 5))), "en", "s") for i in range(80)]
    rows += [(None, passages[4] + "xé" * 40, None, None), (None, passages[4] + "q", "en", "s"),
             (7, passages[5], "en", "s"), (7, passages[5], "en", "s"), (BIG + 3, " " * 5000, "en", "s"),
             (9, " " * 300, "en", "s"), (3, None, "en", "s"), (4, "", "en", "s"),
             (2, "ab" * 400, "en", "s"), (1 << 55, "z" + "ab" * 300, "en", "s")]
    # one passage in many texts, with ever other neighbours
    return rows + [(BIG + 500 + i, text(60) + passages[6][:500] + text(60) + passages[6][500:], "en", "s")
                   for i in range(25)]


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"batches": 1}, {"batches": 7, "hot": 1},
                                     {"least": 30}])
def test_repeats_against_all_windows(spark, options):
    rows = repeating()
    docs = table(spark, rows).repartition(3)
    assert results(suffixes.remove_repeats(docs, **options)) == brute_repeats(
        rows, options.get("least", 50))


def test_many_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HEADS", 500)
    monkeypatch.setattr(suffixes, "PIECE", 4000)
    rows = repeating()
    assert results(suffixes.remove_repeats(table(spark, rows).repartition(3), hot=2)) == brute_repeats(
        rows, 50)
    assert suffixes.remove_repeats(table(spark, [])).count() == 0


def test_text_ids_and_short_least(spark):
    docs = spark.createDataFrame([("b", "x" * 60), ("a", "y" + "x" * 55)], "doc_id string, text string")
    kept = {r.doc_id: r.kept for r in suffixes.remove_repeats(docs).collect()}
    assert kept == {"a": b"y" + b"x" * 55, "b": b""}
    with pytest.raises(ValueError):
        suffixes.remove_repeats(docs, least=10)


def test_batches_added_to_a_family(spark):
    """Batch after batch gives what all rows at once give; equal levels merge."""
    rows = sorted(repeating(), key=lambda r: order(r[0]))
    family, found, sizes, start = suffixes.Family(3), [], [], 0
    for stop in (20, 40, 60, 80, len(rows)):
        while stop < len(rows) and rows[stop][0] == rows[stop - 1][0]:
            stop += 1
        found += results(suffixes.add_batch(family, table(spark, rows[start:stop])))
        sizes.append([n for n, _ in family.levels])
        start = stop
    assert sorted(found) == brute_repeats(rows, 50)
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_queries_on_the_small_tables(spark):
    from counterfold.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(
        "doc_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.QUERIES["op13_suffixes"](spark, SMALL).collect())
    want = [(d[1], *rest) for d, *rest in brute_repeats(rows, 50)]
    assert found == sorted(want)
    words = {r.word: r.n for r in queries.QUERIES["op12_variants"](spark, SMALL).select(
        "word", F.col("n")).collect()}
    assert words == brute_words(rows)


# ---- mended faults: long ids beside nulls, clashing names, long texts


def clashing(spark, rows):
    """Rows of id and text with columns that operators once used inside."""
    names = ["__id", "__key", "__row", "__times", "__n", "__taken", "__lang", "row_key", "times",
             "copy", "lang_as_text"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(
        f"`{n}` int" for n in names)
    return spark.createDataFrame([(*r, *range(len(names))) for r in rows], schema)


def test_long_ids_beside_nulls_and_clashing_names(spark):
    from counterfold.llm import jaccard, mixing, packing, rules, toxicity

    big = (1 << 53) + 1
    rows = [(big + 2 * i, f"w{i} " * 9, "en", "s") for i in range(20)] + [(None, "x y", "en", "s")]
    rows += [(None, "x y", "en", "s"), (big, "w0 " * 9, None, "t"), (big, None, "en", None)]
    docs = clashing(spark, rows)
    want = sorted(r[0] or 0 for r in rows)
    mixed = mixing.mix_sources(docs, keyed=True)
    assert sorted(r.doc_id or 0 for r in mixed.collect()) == want
    repeated = mixing.repeat_rows(docs, mixed)
    assert repeated.columns == docs.columns
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    assert repeated.agg(F.sum(words)).first()[0] == mixed.agg(F.sum("taken")).first()[0]
    assert repeated.where("`__times` <> 3 OR times <> 8").count() == 0
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=16)
    assert {r.doc_id or 0 for r in pieces.collect()} == set(want)
    first = jaccard.keep_first(docs)
    assert first.columns == docs.columns and first.where("`__key` <> 1").count() == 0
    good = rules.keep_good(docs, rules.language_references(docs))
    assert good.columns == docs.columns
    kept = toxicity.drop_toxic(docs, toxicity.ToxicityModel({}))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_targets_against_water_filling(spark):
    """Targets computed a second way: fill the sources one after the other."""
    from counterfold.llm import mixing

    r = random.Random(4)
    for _ in range(3):
        sizes = {f"s{i:02d}": r.choice([1, 5, 40, 300, 2000]) for i in range(r.randint(2, 9))}
        docs = spark.createDataFrame(
            [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())],
            "doc_id long, text string, source string")
        found = {x.source: x.target for x in mixing.mix_sources(docs).collect()}
        weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
        full: set[str] = set()
        while True:
            left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
            rest = sum(w for s, w in weight.items() if s not in full)
            over = {s for s in sizes if s not in full and left * weight[s] / rest > 3 * sizes[s]}
            if not over:
                break
            full |= over
        want = {s: 3.0 * sizes[s] if s in full else left * weight[s] / rest for s in sizes}
        assert all(abs(found[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def maximal_segments(values):
    """All maximal scoring segments by their definition: split at the best, then both sides."""
    best = max(((sum(values[i : j + 1]), -i, -(j - i)) for i in range(len(values))
                for j in range(i, len(values))), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[1] - best[2]
    left = maximal_segments(values[:i])
    right = [(a + j + 1, b + j + 1, s) for a, b, s in maximal_segments(values[j + 1 :])]
    return [*left, (i, j, best[0]), *right]


def test_the_set_of_all_maximal_segments():
    from counterfold.llm import toxicity

    r = random.Random(6)
    for _ in range(300):
        # sums of distinct powers never tie
        values = [r.choice([-1, 1]) * (1 + r.random()) for _ in range(r.randint(1, 14))]
        found = toxicity.segments(values, list(range(len(values))))
        want = maximal_segments(values)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in found], [s for *_, s in want])


def test_a_very_long_text_is_scanned_in_linear_time():
    import time

    from counterfold.llm import toxicity

    scanner = toxicity.Scanner(toxicity.ToxicityModel({"bad": 2.0}))
    start = time.perf_counter()
    n, found = scanner.scan("bad a b c d e f " * 40_000)
    assert n == 280_000 and len(found) == 40_000
    assert time.perf_counter() - start < 10


def test_long_chunks_are_not_remembered():
    import public_tokenizers
    from tokenizers import Tokenizer

    from counterfold.llm import bpe

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        memory, tok = bpe.id_memory(path), Tokenizer.from_file(path)
        r = random.Random(9)
        texts = [" ".join("".join(r.choice("abcXYZé0/=+\t.,") for _ in range(r.choice([1, 3, 8, 10_000])))
                          for _ in range(12)) for _ in range(6)]
        for some in (texts, texts[::-1], ["short one"]):
            for text, ids in zip(some, memory.values(some)):
                want = tok.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(ids, "<u4").tolist() == want
        assert max(map(len, memory.later)) <= bpe.LONG


def test_packing_against_the_library(spark):
    """Every id of every document, by crc32 of what is read back, in gapless sequences."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from counterfold.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, r = Tokenizer.from_file(path), random.Random(3)
    rows = [(i if i % 9 else None, None if i == 5 else " ".join(
        r.choice("the of Été river, <|endoftext|> 12,3 x").split(" ")[0] + r.choice(["", "é", "中"])
        for _ in range(r.randint(0, 90))), "en", "s") for i in range(60)]
    found = packing.pack_documents(table(spark, rows).repartition(3), path, size=64, space=3, merge=2)
    pieces = found.collect()
    want = Counter()
    for doc, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        want[doc, zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, len(p.ids) // 4))
        if p.doc_id is not None:
            by_doc[p.doc_id].append((p.start, p.ids, p.doc_tokens))
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= 64
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    for doc, own in by_doc.items():
        data = b"".join(ids for _, ids, _ in sorted(own))
        assert len(data) // 4 == own[0][2] and want[doc, zlib.crc32(data)] == 1
    assert sum(len(p.ids) // 4 for p in pieces) == sum(
        len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)


def test_packing_holds_few_chunks_where_asked(spark):
    """The same pieces from a small memory, which keeps to its bound."""
    import public_tokenizers

    from counterfold.llm import bpe, packing

    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(4)
    texts = [" ".join(f"w{r.randint(0, 5000)}" for _ in range(400)) for _ in range(40)]
    docs = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).coalesce(1)
    key = lambda p: (p.sequence_id, p.offset)
    found = [sorted(packing.pack_documents(docs, path, remembered=n).collect(), key=key)
             for n in (300, bpe.MEMORY)]
    assert found[0] == found[1]
    memory, most = bpe.id_memory(path, 300), 0
    for t in texts:
        memory.values([t])
        most = max(most, len(memory.later))
    assert 0 < most <= 300 + 300 // 2 + 400  # what was met again, and the text at hand


def test_texts_are_cut_as_one_array_where_pre_tokens_end():
    """Chunks end before lone white space and before marks behind letters; ids are the library's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from counterfold.llm import bpe

    r = random.Random(12)
    alphabet = [*"ab Z 9 '.,!(\n\t \r", "é", "ß", "À", "'s", "'re", " the", "word", "\n\n", "<|", "x.\nY"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "\n", " a", "a ", "a \n", ".", "it's. don't, 中文 x", "stop <|endoftext|> here"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        tok = Tokenizer.from_file(path)
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        for most in (50, 600_000):
            memory = bpe.IdMemory(path, most)
            for _ in range(2):
                got = memory.values(texts)
                assert [np.frombuffer(b, "<u4").tolist() for b in got] == want
            got = [memory.values([t])[0] for t in texts[:200]]
            assert [np.frombuffer(b, "<u4").tolist() for b in got] == want[:200]
        memory = bpe.IdMemory(path, 100)
        memory.values(["One two.\nTwo, two (two) two  two's", "two.\nTwo"])
        assert set(memory.later) == {
            b"One", b" two", b".", b"\nTwo", b",", b" (two", b")", b" two  two's", b"two"}
        asked = []
        learn = memory._learn
        memory._learn = lambda chunks: asked.extend(chunks) or learn(chunks)
        memory.values([" ".join(["two", "three"] * 50)] * 3)
        assert sorted(asked) == [b" three"]


def test_chunks_that_the_normalizer_makes_alike_are_one():
    import public_tokenizers
    from tokenizers import Tokenizer

    from counterfold.llm import bpe

    r = random.Random(4)
    alphabet = [chr(c) for c in bpe.PLAIN] + [*"  \n\t'", "'S", "'LL", "ÀÉ", " The", "İ", "<|endoftext|>"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):  # the former tells case
        path = public_tokenizers.path(name)
        tok, memory = Tokenizer.from_file(path), bpe.IdMemory(path, 1000, fold=True)
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(b, "<u4").tolist() for b in memory.values(texts)] == want
        memory = bpe.IdMemory(path, 100, fold=True)
        memory.values(["a Été été ÉTÉ\nété\tÉTé"])
        assert len(list(memory.later)) == (2 if memory.even else 6)
