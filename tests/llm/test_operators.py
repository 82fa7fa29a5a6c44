"""The text operators on small tables with nulls, empty and long texts, ties and repeats."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from counterfold.llm import ann, chat, idcoder, jaccard, mixing, packing, quality, rules  # noqa: E402
from counterfold.llm import token_counts, token_files, toxicity  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids int, tokens int"
R = random.Random(3)
LONG = " ".join(R.choice("the of and river stone light walks seven quiet".split()) for _ in range(3000))
TEXTS = [
    None, "", " ", "a", "One two.", "  two  spaces\n\nand lines ", "tab\tand nbsp 中文 café",
    "stop <|endoftext|> here", LONG, LONG + " end", "a b c d e f", "a b c d e f", "it's 12,345 o'clock. ",
    "line one\nline two\nline one\n", "Été à la mer, bien sûr.",
]


def table(spark, rows=None):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "nobody")] if rows is None else rows
    return spark.createDataFrame(
        [(i, t, None if k % 5 == 0 else "en", None if k % 3 == 0 else f"s{k % 4}", 0, 1, 2)
         for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, empty):
    found = sorted((r.n_bytes, r.n_tokens, r.over_limit)
                   for r in token_counts.count_tokens(docs, BYTE).collect())
    want = sorted((len((t or "").encode()), len(ids(BYTE, t)), len(ids(BYTE, t)) > 512)
                  for t in [*TEXTS, "a", "nobody"])
    assert found == want
    assert token_counts.count_tokens(empty, BYTE).count() == 0


def test_token_counts_of_other_files(docs):
    found = token_counts.count_tokens(docs, WORDS).agg(F.sum("n_tokens")).first()[0]
    assert found == sum(len(ids(WORDS, t)) for t in [*TEXTS, "a", "nobody"])
    piece = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.count_tokens(docs, piece).count() == len(TEXTS) + 2


def test_whole_tokens_are_single():
    tok, whole = Tokenizer.from_file(BYTE), token_counts.prove_whole_tokens(BYTE)
    some = sorted(whole)[:: len(whole) // 500]
    assert all(len(tok.encode(s, add_special_tokens=False).ids) == 1 for s in some)


def test_packing(docs, empty):
    pieces = packing.pack_documents(docs, BYTE, size=64, end=0, space=3, least_cut=4).toPandas()
    total = sum(len(ids(BYTE, t)) + 1 for t in [*TEXTS, "a", "nobody"])
    pieces["length"] = pieces.ids.map(len) // 4
    assert pieces.length.sum() == total
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == list(np.cumsum([0, *s.length[:-1]])) and s.length.sum() <= 64
    last = pieces[pieces.doc_id == 9].sort_values("start")
    assert np.frombuffer(b"".join(last.ids), "<u4").tolist() == ids(BYTE, TEXTS[9]) + [0]
    assert packing.pack_documents(empty, BYTE).count() == 0


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 65536, n).astype(np.uint16) for n in (0, 1, 33, 500)]
    blocks += [np.tile(np.arange(40, dtype=np.uint16), 90), np.zeros(idcoder.BLOCK, np.uint16)]
    coded = idcoder.encode(blocks)
    assert all((a == b).all() for a, b in zip(idcoder.decode(coded), blocks))
    assert len(coded[5]) < 300 and len(coded[4]) < 1200
    bad = bytearray(coded[4])
    bad[20] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode([bytes(bad)])


def test_coder_keeps_its_bytes_in_small_tables():
    """The coded bytes are those of earlier files; a lane's tables fit 50 kB."""
    r = np.random.default_rng(11)
    blocks = [(r.zipf(1.3, n) % 50_000).astype(np.uint16) for n in (4096, 4096, 700, 33, 1)]
    blocks.append(np.tile(np.arange(40, dtype=np.uint16), 90))
    coded = b"".join(idcoder.encode(blocks))
    assert len(coded) == 8500 and zlib.crc32(coded) == 1134964319
    tables = [x for x in vars(idcoder.Model(8)).values() if isinstance(x, np.ndarray)]
    assert sum(x.nbytes for x in tables) <= 8 * 50_000
    ids = blocks[0]
    for (n, to) in zip(idcoder.RENEW, [*idcoder.RENEW[1:], idcoder.BLOCK]):
        seen, (first, end) = np.sort(ids[:n]), idcoder._ranks(ids)
        assert (first[n:to] == np.searchsorted(seen, ids[n:to], "left")).all()
        assert (end[n:to] == np.searchsorted(seen, ids[n:to], "right")).all()


def test_blocks_of_one_length_are_ranked_together():
    r = np.random.default_rng(5)
    rows = (r.zipf(1.4, (5, 700)) % 50_000).astype(np.uint16)
    first, end = idcoder._ranks(rows)
    for lane, block in enumerate(rows):
        one = idcoder._ranks(block)
        assert (first[lane] == one[0]).all() and (end[lane] == one[1]).all()
    blocks = [*rows, rows[0][:0], *(r.integers(0, 65536, n).astype(np.uint16) for n in (65, 64, 700))]
    coded = idcoder.encode(blocks)
    assert all((a == b).all() for a, b in zip(idcoder.decode(coded), blocks))
    assert all(idcoder.encode([b]) == [c] for b, c in zip(blocks, coded))


def test_predictions_are_foretold_as_a_model_makes_them():
    r = np.random.default_rng(7)
    rows = np.concatenate([np.tile(r.integers(0, 65536, 9), 30)[None], r.zipf(1.5, (4, 270)) % 65536])
    rows = rows.astype(np.uint16)
    told, model = idcoder._foretold(rows), idcoder.Model(len(rows))
    for t, ids in enumerate(rows.T.astype(np.int32)):
        named, _ = model.predict(len(rows), 0)
        assert ((told[:, t] & 7) == model.level[0]).all() and ((told[:, t] >> 3 & 7) == model.level[1]).all()
        assert ((told[:, t] >> 6 & 1) == (named[0] == ids)).all() and ((told[:, t] >> 7) == (named[1] == ids)).all()
        model.learn(len(rows), ids, ids < 0, 0)
    assert (told & 7).max() == 7 and not idcoder._foretold(rows[:, :0]).size


def test_files_are_decoded_in_few_wide_tasks(spark, docs, tmp_path):
    wide = docs.repartition(16)
    target = token_files.write_token_files(wide, WORDS, str(tmp_path / "w"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        most = spark.sparkContext.defaultParallelism
        assert spark.read.parquet(target).rdd.getNumPartitions() > most
        found = token_files.read_token_files(spark, target)
        assert found.rdd.getNumPartitions() <= most and found.count() == docs.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_token_files(spark, docs, empty, tmp_path):
    target = token_files.write_token_files(docs, WORDS, str(tmp_path / "t"))
    found = token_files.read_token_files(spark, target).toPandas().sort_values("start")
    rows = sorted([(-1, "nobody"), *((i, t or "") for i, t in enumerate(TEXTS)), (3, "a")])
    want = [ids(WORDS, t) + [1] for _, t in rows]
    assert [np.frombuffer(b, "<u4").tolist() for b in found.ids] == want
    assert list(found.start) == list(np.cumsum([0, *map(len, want[:-1])]))
    target = token_files.write_token_files(empty, WORDS, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, target).count() == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_rules_base_counts(docs, empty):
    refs = rules.language_references(docs, least_docs=1)
    found = {r.doc_id: r for r in rules.judge(docs, refs).collect()}
    for i, t in enumerate(TEXTS):
        w = words_of(t)
        windows = defaultdict(list)
        for k in range(len(w) - 7):
            windows[tuple(w[k : k + 8])].append(k)
        repeat = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(8)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(repeat))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeat) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    none = rules.language_references(empty)
    assert rules.judge(empty, none).count() == 0 and rules.keep_good(empty, none).count() == 0


def test_rules_of_many_and_small_languages(spark):
    r = random.Random(5)
    rows = []
    for k in range(72):  # each with words of its own
        n = 19 if k > 69 else 20 + (k < 68)
        own = [chr(97 + i % 26) + chr(97 + i // 26) + chr(0x4E00 + k) for i in range(30)]
        rows += [(f"{k:02d}", " ".join(r.choices(own, k=200))) for _ in range(n)]
    rows += [(None, rows[0][1]), ("01", "x" * 400 + " y z" * 99)]
    df = spark.createDataFrame(
        [(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    refs = rules.language_references(df)
    assert len(refs.names) == 70
    found = {x.doc_id: x for x in rules.judge(df, refs).collect()}
    assert all(found[i].kept for i in range(len(rows) - 1))
    assert not found[len(rows) - 1].kept
    small = [i for i, (lang, _) in enumerate(rows) if lang in ("70", "71", None)]
    assert all(found[i].word_distance is None for i in small)
    assert rules.keep_good(df, refs).count() == len(rows) - 1


def test_rules_common_words_of_any_length(spark):
    """References against a count of all words, with letters of three bytes and long words."""
    r = random.Random(6)
    common = ["में", "और", "हैं", "लिए", "करने", "उनके", "ā" * 80, "ऊ" * 22 + "x"]
    rows = []
    for k in range(70):
        rare = ["".join(r.choices("कखगघचछजझटठडढणतथदधन", k=4)) for _ in range(200)]
        rows.append((" ".join(r.choice(common) if r.random() < 0.6 else w for w in rare),
                     ["hi", None][k % 2]))
    rows.append((" ".join("".join(r.choices("कखगघचछजझटठडढणतथदधन", k=4)) for _ in range(200)), "hi"))
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string")
    refs = rules.language_references(df)
    found = {x.doc_id: x for x in rules.judge(df, refs).collect()}
    junk = found[len(rows) - 1]  # none of its words is common
    assert not junk.base_failed and junk.word_distance > 0.4 and not junk.kept
    assert all(found[i].kept for i in range(len(rows) - 1))
    words = rows[0][0].encode().split()
    seen = [[sum(rules.named(w) == x for w in words) for x in index] for index in refs.words]
    exact = min(float(rules.distance(np.array([*n, len(words) - sum(n)], float), q))
                for n, q in zip(seen, refs.shares))
    assert abs(found[0].word_distance - exact) < 1e-12
    for refs in (refs, rules.language_references(df.repartition(3), held=1)):
        assert refs.names == ["hi", None]
        for lang, index, shares in zip(refs.names, refs.words, refs.shares):
            count = Counter(w for t, x in rows if x == lang for w in t.encode().split())
            top = sorted(count.values(), reverse=True)[:40]
            total = sum(count.values())
            assert np.allclose(shares, np.array([*top, total - sum(top)]) / total)
            assert list(index.values()) == list(range(40))
            for w in common:
                assert shares[index[rules.named(w.encode())]] == count[w.encode()] / total


def test_distance_of_histograms():
    p, q = np.array([2.0, 0, 2]), np.array([[0.5, 0, 0.5], [0, 1, 0]])
    assert np.allclose(rules.distance(p, q), [0, 1])


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        n = min(size, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            a, b = sets[i], sets[j]
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components(spark, empty):
    r, rows = random.Random(5), []
    vocabulary = [f"w{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=60)
    for group in range(12):
        base = r.choices(vocabulary, k=r.choice([3, 5, 30, 120, 300]))
        base = base + passage if group % 3 == 0 else base
        for _ in range(r.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, "A b"), (1003, "a B"), (1004, " ")]
    found = {r.doc_id: (r.n_shingles, r.component_id)
             for r in jaccard.jaccard_components(
                 table(spark, rows + [(None, None), (1003, "a B")]), size=4, percent=85).collect()}
    assert found.pop(None) == (0, None)
    assert found == brute_components(rows, 4, 85)
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_of_one_large_group_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    r, rows = random.Random(11), []
    vocabulary = [f"w{i}" for i in range(4000)]
    base = r.choices(vocabulary, k=150)
    for _ in range(160):  # many pairs are a little above the limit, many a little below
        copy = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 6, 8])):
            copy[r.randrange(len(copy))] = r.choice(vocabulary)
        rows.append((len(rows), " ".join(copy)))
    r.shuffle(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(
        table(spark, rows), size=4, percent=85).collect()}
    want = brute_components(rows, 4, 85)
    assert found == want
    assert len({c for _, c in want.values()}) > 3


def test_overlaps_of_sets():
    r = np.random.default_rng(2)
    some = lambda n: np.unique(r.integers(0, 300, n).astype(np.uint64))
    a, b = [some(n) for n in (1, 40, 90, 7)], [some(n) for n in (60, 3)]
    for x, y in ((a, b), (a, a), (a[:1], b[:1])):
        want = [[len(np.intersect1d(s, t)) for t in y] for s in x]
        got = jaccard.overlaps(x, y, width=16)
        same = x is y  # a set's overlap with itself is not asked for
        assert all(got[i, j] == want[i][j] for i in range(len(x)) for j in range(len(y))
                   if not (same and i == j))


def test_keep_first_keeps_one_row_a_group(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = table(spark, [(5, text), (4, text), (4, text), (9, text + " more"), (7, "other words")])
    assert sorted(r.doc_id for r in jaccard.keep_first(rows).collect()) == [4, 7]


def test_keep_first_tells_rows_without_or_with_shared_ids_apart(spark):
    text = [" ".join(f"{v}{i}" for i in range(50)) for v in "abcdefgh"]
    near = text[4] + " more"
    rows = [
        (1, text[0]), (None, text[0]),  # a copy of a document with an id
        (None, text[1]), (None, text[1]), (None, text[2]), (None, text[4]), (None, near),
        (2, text[3]), (2, text[0]), (2, text[5]), (2, text[5] + " more"),  # an old and two new
        (3, ""), (3, None), (4, " "),
    ]
    kept = sorted((r.doc_id or 0, r.text or "") for r in
                  jaccard.keep_first(table(spark, rows)).collect())
    assert kept == sorted([
        (1, text[0]), (0, text[1]), (0, text[2]), (0, text[4]), (2, text[3]), (2, text[5]),
        (3, ""), (4, " ")])
    # a null id without shingles, too
    lost = table(spark, [(None, ""), (None, text[6]), (None, text[7]), (5, text[6])])
    assert sorted((r.doc_id or 0, r.text) for r in jaccard.keep_first(lost).collect()) == [
        (0, ""), (0, text[7]), (5, text[6])]


def test_mixing(spark, docs, empty):
    rows = [(i, "w " * (i % 37 + 1)) for i in range(900)] + [(None, "a b"), (3, "w w w w"), (4, None)]
    df = table(spark, rows).withColumn("source", F.when(F.col("doc_id") < 500, "big").otherwise(
        F.when(F.col("doc_id") < 520, "tiny").when(F.col("doc_id") < 800, "other")))
    found = mixing.mix_sources(df, block=200).toPandas()
    again = mixing.mix_sources(df.repartition(7), block=200).toPandas()
    key = ["doc_id", "size", "taken"]
    assert found[key].sort_values(key).values.tolist().__str__() == again[key].sort_values(
        key).values.tolist().__str__()
    assert (found.taken <= 3 * found["size"]).all() and len(found) == len(rows)
    by = found.groupby("source", dropna=False).agg(
        t=("target", "first"), s=("source_size", "first"), n=("taken", "sum"))
    assert abs(by.t.sum() - by.s.sum()) < 1e-6 and (by.t <= 3 * by.s + 1e-9).all()
    assert by.t["tiny"] == 3 * by.s["tiny"]
    assert (abs(by.n - by.t) <= 37).all()  # one document
    assert mixing.mix_sources(empty).count() == 0
    repeated = mixing.repeat_rows(df, mixing.mix_sources(df, block=200, keyed=True))
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    assert repeated.agg(F.sum(words)).first()[0] == found.taken.sum()
    assert repeated.columns == df.columns


def test_mixing_of_a_source_does_not_depend_on_the_size_of_others(spark):
    r = random.Random(8)
    rows = [(k, "w " * r.randint(50, 500), f"s{k % 6}") for k in range(180)]
    rows += [(k, "w " * r.randint(50, 500), "s6") for k in range(180, 240)]  # three blocks
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(df, block=25).toPandas()
    assert len(found) == len(rows)
    by = found.groupby("source").agg({"taken": "sum", "target": "first"})
    assert (by.taken - by.target).abs().max() < 5  # words; a document has 275
    small = mixing.mix_sources(df, block=40).toPandas()  # all but one source have one block
    by = small.groupby("source").agg({"taken": "sum", "target": "first"})
    assert (by.taken - by.target).abs().max() < 5


def test_flight_keeps_totals():
    r = random.Random(1)
    sizes, chances = [r.randrange(1, 99) for _ in range(500)], [r.random() for _ in range(500)]
    done = mixing.flight([float(s) for s in sizes], chances, r.random)
    assert sum(0 < c < 1 for c in done) <= 2
    assert abs(sum(done) - sum(chances)) < 1e-6
    assert abs(np.dot(done, sizes) - np.dot(chances, sizes)) < 1e-4


def test_segments_against_all_sums():
    r = random.Random(2)
    for _ in range(200):
        values = [r.choice([2.0, 1.5, -0.5, -1.0]) for _ in range(12)]
        best = max([0.0] + [sum(values[i:j]) for i in range(12) for j in range(i + 1, 13)])
        found = toxicity.segments(values, list(range(12)))
        assert max([0.0] + [s for _, _, s in found]) == pytest.approx(best)
        assert all(sum(values[a : b + 1]) == pytest.approx(s) for a, b, s in found)


@pytest.fixture(scope="module")
def labelled(spark):
    r, rows, labels = random.Random(4), [], []
    for i in range(400):
        words = r.choices([f"w{k}" for k in range(200)], k=60)
        toxic, good = i % 5 == 0, i % 3 != 0
        if toxic:
            for k in (10, 12, 15):
                words[k] = r.choice(["awful", "nasty", "vileness"])
        if not good:
            words = [w.upper() + "###" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_learned_scores_on_rows_held_out(spark, docs, empty, labelled, name):
    rows, labels = labelled
    fit, score = {"toxic": (toxicity.fit_toxicity, toxicity.score_toxicity),
                  "quality": (quality.fit_quality, quality.score_quality)}[name]
    model = fit(rows, labels)
    got = score(rows, model).join(labels, "doc_id").toPandas()
    held = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]]
    assert (held.predicted == held[name]).mean() > 0.95
    assert got.score.between(0, 1).all()
    assert score(docs, model).count() == len(TEXTS) + 2 and score(empty, model).count() == 0
    blank = fit(empty, labels.limit(0))
    assert score(docs, blank).select("predicted").distinct().count() == 1


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """More labelled rows than were once sampled: means and threshold are those of all."""
    n = 30_000
    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    text = F.when(F.col("id") % 3 == 0, F.concat(word, F.lit(" ### OK"))).otherwise(
        F.concat_ws(" ", word, F.lit("is good"), F.col("id") % 7))
    rows = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(n).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("quality"))
    monkeypatch.setattr(quality, "FEW_VALUES", 500)
    model = quality.fit_quality(rows, labels)
    kept = [r for r in rows.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    x = np.array([quality.features(r.text.encode()) for r in kept])
    assert np.allclose(model.mean, x.mean(0), atol=1e-12)
    assert np.allclose(model.spread, x.std(0) + 0.05, atol=1e-12)
    ranks, cut = np.sort(model.rank(x)), sum(r.doc_id % 3 == 0 for r in kept)
    assert np.isclose(model.threshold, (ranks[cut - 1] + ranks[cut]) / 2)


def test_order_statistics_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW_VALUES", 2)
    values = np.round(np.random.default_rng(4).normal(size=400) ** 3, 2)
    table = spark.createDataFrame([(float(v),) for v in values], "s double")
    assert [quality.order_statistic(table, k) for k in (0, 200, 399)] == list(np.sort(values)[[0, 200, 399]])


def test_passages_are_found(labelled):
    rows, labels = labelled
    model = toxicity.fit_toxicity(rows, labels)
    found = toxicity.score_toxicity(rows.where("doc_id = 10"), model).first()
    assert [(p.first, p.last) for p in found.passages] == [(10, 15)]
    assert toxicity.drop_toxic(rows, model).where("doc_id = 10").count() == 0


CHAT = [
    (1, 0, "user", "hi <|end|> <\\|end|> </s>"), (1, 1, "assistant", "a<|turn|>b"),
    (1, 2, "user", None), (1, 3, "assistant", "[INST] x [/INST] 中"), (1, 3, "assistant", "z"),
    (2, None, None, ""), (None, 0, "assistant", "alone"),
]


def read_back(df):
    chats = chat.format_chats(df)
    return {r.conv_id: (r.turns, r.loss) for r in chats.select(
        "conv_id", chat.read_chats(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    found = read_back(chat.to_turns(rows))
    assert [tuple(t) for t in found[1][0]] == [(r, t or "") for _, _, r, t in CHAT[:5]]
    assert found[1][1] == "a<|turn|>b[INST] x [/INST] 中z"
    assert found[2] == ([("", "")], "") and found[None][1] == "alone"
    assert chat.format_chats(chat.to_turns(rows.limit(0))).count() == 0


def test_chat_layouts(spark):
    messages = spark.sql("""SELECT 1 AS conv_id, 5 AS extra, array(
        named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', 'a'))
        AS messages""")
    fixed = spark.sql("SELECT 2 AS conv_id, 'do' AS instruction, 'it' AS input, 'done' AS output")
    jsons = spark.createDataFrame([
        (3, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'),
        (4, '{"prompt": "q", "response": "a"}')], "conv_id long, j string")
    qa = [("user", "q"), ("assistant", "a")]
    turns = lambda df: [tuple(t) for _, (ts, _) in sorted(read_back(df).items()) for t in ts]
    assert turns(chat.to_turns(messages)) == qa
    assert turns(chat.to_turns(fixed)) == [("user", "do\nit"), ("assistant", "done")]
    assert turns(chat.json_to_turns(jsons, "j")) == qa + qa
    with pytest.raises(ValueError):
        chat.to_turns(spark.range(1).withColumnRenamed("id", "conv_id"))


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 20)).astype(float)
    x[800:830] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (2000, None), (2100, [0.0] * 20), (2200, [float("nan")] * 20), (2300, [1.0]), (None, x[0].tolist()),
        (2400, [None] * 20)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    found = ann.search(df, F.col("id") % 100 == 0, ann.fit_index(df)).toPandas()
    assert set(found.query_id) == set(range(0, 900, 100))
    hit = 0
    for q, g in found.groupby("query_id"):
        apart = np.sqrt(((x - x[q]) ** 2).sum(1))
        apart[q] = np.inf
        want = np.lexsort((np.arange(900), apart))[:10]
        hit += len(set(want) & set(g.vec_id))
        assert np.allclose(g.sort_values("rank").score, apart[g.sort_values("rank").vec_id])
    assert hit >= 81
    twin = found[found.query_id == 800].sort_values("rank")
    assert list(twin.vec_id) == [5, *range(801, 810)] and (twin.score == 0).all()
    assert ann.search(df.limit(0), F.lit(True), ann.fit_index(df.limit(0))).count() == 0
    three = df.where("id < 3")
    assert ann.search(three, F.lit(True), ann.fit_index(three)).count() == 6


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"
