"""Operators 1, 5, 6, 7, 9 and 10 against brute force, and their edge cases."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from mcqflow.llm import components, decontam, jaccard, langid, quality_mil, queries, sentencepieces, tokenids

WORD = re.compile("[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
EDGE = [(900, None), (901, ""), (902, " \n"), (None, "one two"), (None, "one two"), (903, "long " * 30000), (904, "one two"), (904, "one two")]


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_jaccard_join_against_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for i in range(30):
        w = [f"v{rng.randint(0, 3000)}" for _ in range(rng.randint(3, 120))]
        for c in range(rng.choice([1, 1, 2, 5])):
            x = list(w)
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x))] = f"v{rng.randint(0, 3000)}"
            rows.append((len(rows), " ".join(x)))
    rows += EDGE
    sets = [shingles(t) for _, t in rows]
    link = [[0] * len(rows) for _ in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) * 1000 >= 800 * len(sets[a] | sets[b]):
            link[a][b] = link[b][a] = 1
    got = jaccard.report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r.doc_id), r.n_links) for r in got) == sorted((str(d), sum(link[k])) for k, (d, _) in enumerate(rows))
    up = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if link[a][b]:
            up = [up[a] if x == up[b] else x for x in up]
    least = {g: min((rows[k][0] for k in range(len(rows)) if up[k] == g and rows[k][0] is not None), default=None) for g in set(up)}
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == sorted((str(d), str(least[up[k]])) for k, (d, _) in enumerate(rows))
    kept = jaccard.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert len(kept) == len(set(up))
    assert jaccard.report(spark.createDataFrame([], DOCS)).count() == 0


def test_near_copy_group_larger_than_a_block(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1:])) for i, k in enumerate(np.random.RandomState(1).randint(0, 200, 600).tolist())]
    got = jaccard.report(spark.createDataFrame(rows, DOCS)).collect()
    sets = [shingles(t) for _, t in rows]
    want = [sum(1 for j in range(600) if j != i and len(sets[i] & sets[j]) * 1000 >= 800 * len(sets[i] | sets[j])) for i in range(600)]
    assert {r.doc_id: r.n_links for r in got} == dict(enumerate(want))
    assert {r.class_id for r in got} == {0}


def _links_by_counting(rows):
    sets = [shingles(t) for _, t in rows]
    near = lambda a, b: len(a & b) * 1000 >= 800 * len(a | b)
    return {d: sum(1 for j, b in enumerate(sets) if j != i and near(sets[i], b)) for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("block", [3, 8, 64])
def test_groups_meet_whole_or_by_band_values(spark, block):
    """Pages of one template (candidates, few links) and near copies, with small blocks: the links of all pairs."""
    rng = random.Random(12)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(150):  # two template groups of which one gets near copies of some pages
        w = [x if rng.random() < 0.86 else f"p{rng.randint(0, 10**6)}" for x in base]
        rows.append((len(rows), " ".join(w)))
        for _ in range(rng.choice([0, 0, 0, 2])):
            rows.append((len(rows), " ".join(w[:-1] + [f"e{len(rows)}"])))
    rows += [(len(rows) + i, " ".join(base[:40] + [f"n{i}"] + base)) for i in range(40)]
    got = jaccard.join(spark.createDataFrame(rows, DOCS), block=block).collect()
    want = _links_by_counting(rows)
    assert sum(want.values()) > 1600 and {r.doc_id: r.n_links for r in got} == want


def test_template_pages_meet_by_band_values_only(spark):
    """A group that only chains of shared bands hold together: no set is copied more than its bands say,
    and far fewer pairs meet than the group has."""
    rng = random.Random(6)
    base = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(x if rng.random() < 0.89 else f"p{i}_{k}" for k, x in enumerate(base))) for i in range(1200)]
    docs = spark.createDataFrame(rows, DOCS)
    sign = jaccard.signed(docs).where("sid is not null").toPandas().drop_duplicates("sid")
    keys = np.stack(sign["bands"].to_list())
    up = list(range(len(keys)))
    values = [list(v) for b in range(keys.shape[1]) for v in sign.groupby(keys[:, b]).indices.values() if len(v) > 1]
    for v in values:
        for x in v:
            up = [up[v[0]] if u == up[x] else u for u in up] if up[x] != up[v[0]] else up
    label, n_grp = np.unique(up, return_counts=True)
    assert n_grp.max() > 2 * jaccard.BLOCK  # one candidate group of several blocks
    groups = spark.createDataFrame([(bytes(sign["sid"].iloc[i]), str(u).encode(), int(n_grp[label == u][0])) for i, u in enumerate(up)],
                                   "sid binary, grp binary, n_grp long")
    keyed = spark.createDataFrame([(bytes(s), b, int(k)) for s, row in zip(sign["sid"], keys) for b, k in enumerate(row)],
                                  "sid binary, band int, key long")
    spots = jaccard._spots(groups, keyed, 16).collect()
    assert spots and max(len(r.spots) for r in spots) <= jaccard.BANDS
    meet = {}
    for r in spots:
        for s in r.spots:
            meet[s.band, s.key] = meet.get((s.band, s.key), 0) + 1
    assert sum(m * (m - 1) // 2 for m in meet.values()) < n_grp.max() * (n_grp.max() - 1) // 2
    got = jaccard.report(docs).collect()
    assert {r.doc_id: r.n_links for r in got} == _links_by_counting(rows)


def test_agreeing_pairs_against_loops():
    r = np.random.RandomState(2)
    for n, m in ((5, 7), (90, 80)):
        ka, kb = r.randint(0, 400, (n, 32)), r.randint(0, 400, (m, 32))
        first = {(i, j): next((k for k in range(32) if ka[i, k] == kb[j, k]), None) for i in range(n) for j in range(m)}
        assert set(zip(*map(np.ndarray.tolist, jaccard._agreeing(ka, kb, False, -1)))) == {p for p, k in first.items() if k is not None}
        for band in (0, 9, 31):  # a unit of a band: all its rows agree there
            kb[:, band] = ka[:, band] = 7
            first = {(i, j): next(k for k in range(32) if ka[i, k] == kb[j, k]) for i in range(n) for j in range(m)}
            assert set(zip(*map(np.ndarray.tolist, jaccard._agreeing(ka, kb, False, band)))) == {p for p, k in first.items() if k == band}
    same = jaccard._agreeing(ka, ka, True, -1)
    assert (same[0] < same[1]).all() and len(same[0]) == 90 * 89 // 2


def test_components_of_a_chain(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (5, 5)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def semi_global(p, t):
    prev = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        cur = [i]
        for j, c in enumerate(t, 1):
            cur.append(min(prev[j - 1] + (a != c), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_decontamination_against_alignment(spark):
    rng = random.Random(5)
    norm = lambda s: " ".join(s.split()).lower()
    text = lambda n: norm("".join(rng.choice("abcde fgé") for _ in range(n)))
    items = [text(rng.randint(40, 140)) for _ in range(8)]
    rows = []
    for n in range(30):
        s = list(rng.choice(items))
        for _ in range(rng.randint(0, 9)):
            k = rng.randrange(len(s))
            s[k:k + rng.randint(0, 1)] = rng.choice(["x", "yz", ""])
        rows.append((n, text(rng.randint(0, 90)) + "".join(s).upper().replace(" ", " \n") + text(50)))
    rows += EDGE
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "  "), (92, "tiny"), (93, items[0])], "item_id long, text string")
    want = {(d, k) for d, t in rows for k, p in enumerate(items) if semi_global(p, norm(t or "")) <= int(0.05 * len(p))}
    want |= {(d, 93) for d, k in want if k == 0}
    for block in (4_000_000, 200):
        got = decontam.find_matches(spark.createDataFrame(rows, DOCS), bench, block_chars=block)
        assert {(r.doc_id, m.item_id) for r in got.collect() for m in r.matches} == want
    assert decontam.decontaminate(spark.createDataFrame(rows, DOCS), bench).count() == len(rows) - len({d for d, _ in want})
    assert decontam.find_matches(spark.createDataFrame([], DOCS), bench).count() == 0
    assert decontam.decontaminate(spark.createDataFrame(rows, DOCS), bench.limit(0)).count() == len(rows)


def test_jaccard_row_key_names_rows_apart(spark):
    """128 bits, and no two of these rows share them: NULLs, empty texts, id and text run together."""
    rows = [(None, None), (None, ""), (1, None), (1, ""), (1, "1"), (11, ""), (11, "1"), (1, "\n=1"), (None, "-"), (None, "=")]
    keys = [r.k for r in spark.createDataFrame(rows, DOCS).select(jaccard.row_key().alias("k")).collect()]
    assert len(set(keys)) == len(rows) and {len(k) for k in keys} == {16}
    docs = spark.createDataFrame([(7, "one two three four five six")] * 40 + [(8, "other words stand in this text")], DOCS)
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == [7, 8]
    assert {(r.doc_id, r.n_links) for r in jaccard.report(docs).collect()} == {(7, 39), (8, 0)}


def _found(items, texts):
    index = decontam.Index(list(range(len(items))), items)
    return decontam._search(index, pa.array(texts, pa.string()))


@pytest.mark.parametrize("pairs, cells", [(1, 1), (50, 300), (5000, 10**6)])
def test_decontamination_in_parts_finds_the_same(monkeypatch, pairs, cells):
    """Repetitive items and texts, several rows and items: any size of the parts gives the same matches."""
    r = np.random.RandomState(3)
    pick = lambda n, letters: "".join(r.choice(list(letters), n))
    items = ["=" * 60, "ab" * 40, pick(90, "ab"), pick(200, "abc"), "-" * 25, "=" * 59 + "x", pick(130, "xyz ")]
    texts = ["=" * 300, "q" + "ab" * 100, pick(500, "ab"), items[3][:90] + "z" + items[3][90:] + "=" * 57, "", None,
             "-" * 24 + "+" + "-" * 90, items[6], pick(800, "ab") + items[2] + "=-" * 50, "=" * 59 + "x"]
    monkeypatch.setattr(decontam, "PAIRS", 1 << 40)
    want = _found(items, texts)
    assert sum(map(len, want)) > 12
    monkeypatch.setattr(decontam, "PAIRS", pairs)
    monkeypatch.setattr(decontam, "CELLS", cells)
    assert _found(items, texts) == want


def test_decontamination_bands_against_counting(monkeypatch):
    """Both ways of counting against plain loops over bands and positions."""
    r = np.random.RandomState(8)
    items = ["=" * 40, "ab" * 30, "".join(r.choice(list("ab"), 50))]
    texts = ["=" * 90, "x" + "ba" * 45, "".join(r.choice(list("ab"), 150)) + items[2]]
    index = decontam.Index([0, 1, 2], items)
    c, off = decontam.normalized(pa.array(texts))
    q, want = decontam.Q, set()
    for x, t in enumerate(texts):
        for y, item in enumerate(items):
            w = int(index.k[y]) + 1
            for band in range(-len(item) - 2, len(t) + 1):
                own = {j for j in range(len(item) - q + 1) for i in range(max(0, j + band * w), min(len(t) - q + 1, j + (band + 2) * w))
                       if t[i:i + q] == item[j:j + q]}
                if len(own) >= index.need[y]:
                    want.add((x, y, band * w))
    for pairs in (1, 1 << 40):
        monkeypatch.setattr(decontam, "PAIRS", pairs)
        got = list(zip(*(a.tolist() for a in index.regions(c, off))))
        assert len(got) == len(set(got)) and set(got) == want


def test_decontamination_of_a_long_ruler_is_bounded():
    """500 equal characters against 60,000: 488 * 59,989 pairs of positions."""
    import tracemalloc
    tracemalloc.start()
    found, = _found(["=" * 500], ["=" * 60000])
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and top < 300e6 and all(v == 0 for *_, v in found)
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))


def test_decontamination_finds_items_shorter_than_a_gram(spark):
    items = ["日本の首都は何処ですか", "aa", "Q", "two  words", "aa", "abcdefghijkl", "aaab"]
    rows = [(1, "問：日本の首都は何処ですか。"), (2, "xaaaaab"), (3, "日本の首都は"), (4, "one two"), (5, "two"), (6, "words two\nWords q"), (7, "abcdefghijk"), (8, "abcdefghijkl"), *EDGE[:3]]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    want = set()
    for d, t in rows:
        t = " ".join((t or "").split()).lower()
        for k, p in enumerate(items):
            p = " ".join(p.split()).lower()
            want |= {(d, k, m.start(), m.end(), 0) for m in re.finditer(re.escape(p), t)}
    for block in (4_000_000, 10):
        got = decontam.find_matches(spark.createDataFrame(rows, DOCS), bench, block_chars=block).collect()
        assert sorted((r.doc_id, *m) for r in got for m in r.matches) == sorted(want)
    assert decontam.decontaminate(spark.createDataFrame(rows, DOCS), bench).select("doc_id").where("doc_id < 900").collect() == [(3,), (4,), (5,), (7,)]


def test_decontamination_folds_all_white_space(spark):
    item = "".join(f"列{k}\u3000\u3000\xa0値\u2028{k}" for k in range(8))
    plain = " ".join(item.split())
    rows = [(1, item), (2, "前 " + plain + " 後"), (3, "x" + item), (4, "列 値")]
    for benchmark in (item, plain, "\u3000 " + item + "\u2003\n"):
        got = decontam.report(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(7, benchmark)], "item_id long, text string")).collect()
        assert sorted((r.doc_id, r.start, r.end, r.distance) for r in got) == [(1, 0, len(plain), 0), (2, 2, 2 + len(plain), 0), (3, 1, 1 + len(plain), 0)]
    assert {ch for ch in map(chr, range(0x110000)) if ch.isspace()} == {ch for ch in map(chr, range(0x110000)) if re.match(decontam._WIDE, ch) or WORD.match(ch) is None}


def test_decontamination_holds_one_block_at_a_time(spark):
    items = [(i, f"item number {i} of the long benchmark") for i in range(60)]
    rows = [(i % 50, f"so {items[i % 60][1]} and {items[(i + 7) % 60][1]}", i) for i in range(150)] + [(None, None, 1), (3, "clean", 2)]
    docs, bench = spark.createDataFrame(rows, DOCS + ", x long"), spark.createDataFrame(items, "item_id long, text string")
    one = decontam.find_matches(docs, bench)
    many = decontam.find_matches(docs, bench, block_chars=300)
    assert many.columns == one.columns and many.schema["matches"].dataType == one.schema["matches"].dataType
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    assert one._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert "MapInArrow" not in many._jdf.queryExecution().executedPlan().toString()  # each block's pass is over


def test_language_words_sum_over_all_segmentations():
    path = queries.vocabulary("piece_bpe_32k.model")
    pieces = langid.vocabulary(path)
    ids, lat = {p: i for i, p in enumerate(pieces)}, langid.Lattice(pieces)
    prob = np.random.RandomState(0).rand(len(pieces), 2)
    prob /= prob.sum(0)
    ws = ["the", "international", "für", "日本x", "\U0001F600a", "ab" * 40, "x"]
    got = langid.word_scores(lat, ws, prob)
    for k, w in enumerate(ws):
        w = "▁" + w
        a = [np.ones(2)] + [np.zeros(2) for _ in w]
        for j in range(1, len(w) + 1):
            for i in range(max(0, j - 16), j):
                if w[i:j] in ids:
                    a[j] = a[j] + a[i] * prob[ids[w[i:j]]]
            if w[j - 1] not in ids:
                a[j] = a[j] + a[j - 1] * langid.UNKNOWN
        assert np.allclose(got[k], np.log(a[-1]))


def test_language_held_out_and_edges(spark):
    got = queries.QUERIES["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    path = queries.vocabulary("piece_bpe_32k.model")
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"), path, rounds=1)
    rows = langid.identify(spark.createDataFrame([*EDGE, (905, "123 !!")], DOCS), model, path).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (900, 901, 902, 905)} == {900: "und", 901: "und", 902: "und", 905: "und"}
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(EDGE) + 1
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"), path)
    assert langid.identify(spark.createDataFrame(EDGE, DOCS), none, path).where("lang_pred <> 'und'").count() == 0


def test_rare_languages_are_learned(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(40000)]
    rows += [(50001, "der hund und die katze", "de"), (50004, "le chien et le chat", "fr"), (50002, "123", "xx"), (50003, None, "yy")]
    path = queries.vocabulary("piece_bpe_32k.model")
    model = langid.train(spark.createDataFrame(rows, DOCS + ", lang string"), path, rounds=1)
    assert model["langs"] == ["de", "en", "fr"]
    n = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(40000))
    assert np.allclose(model["prior"], np.array([1, n, 1]) / (n + 2))
    got = langid.identify(spark.createDataFrame([(1, "die katze"), (2, "le chat"), (3, "the mat")], DOCS), model, path).collect()
    assert [r.lang_pred for r in got] == ["de", "fr", "en"]


def test_quality_held_out_and_edges(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [r for r in queries.QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in got) >= 0.9 * len(got)
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in EDGE], "doc_id long, text string, score double")
    rows = quality_mil.classify(docs, quality_mil.fit(np.zeros((0, quality_mil.N_FEATURES)), np.zeros(1, np.int64), np.zeros(0))).collect()
    assert [r.score for r in rows] == [0.5] * len(EDGE)
    assert quality_mil.classify(docs.limit(0), {"share": 0.5}).count() == 0


def test_quality_gradient_is_right():
    rng = np.random.RandomState(2)
    x, pf, y = rng.randn(40, quality_mil.N_FEATURES), np.array([0, 3, 10, 11, 25, 40]), np.array([0, 1, 1, 0, 1.0])
    p = quality_mil.fit(x, pf, y, epochs=200)
    assert ((quality_mil.score(p, x, pf) > 0.5) == (y > 0.5)).all()


def test_quality_is_fitted_on_every_passage(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality_mil, "fit", lambda x, pf, y: seen.update(n=np.diff(pf).tolist(), y=y.tolist()))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, "word " * (32 * 200 if k == 3 else 40)) for k, i in enumerate(ids)], DOCS)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    quality_mil.train(docs, labels)
    assert seen["n"] == [200 if k == 3 else 2 for k in range(len(ids))]
    quality_mil.train(docs.where(f"doc_id <> {ids[3]}"), labels, max_passages=2 * len(ids) // 4)
    assert set(seen["n"]) == {2} and 0 < len(seen["n"]) < len(ids) // 2


def test_quality_fits_one_text_a_doc_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_mil, "fit", lambda x, pf, y: seen.append((x, np.diff(pf).tolist(), y.tolist())))
    a, b = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5][:2]
    rows = [(a, "one two")] * 300 + [(a, "word " * 40), (a, None), (b, "word " * 100)]
    labels = spark.createDataFrame([(a, 1), (b, 0)], "doc_id long, quality int")
    for parts in (1, 7):
        quality_mil.train(spark.createDataFrame(rows, DOCS).repartition(parts), labels)
    assert [sum(n) for _, n, _ in seen] in ([5, 5], [6, 6]) and seen[0][1:] == seen[1][1:] and seen[0][2] == [1, 0]
    assert np.array_equal(seen[0][0], seen[1][0])
    quality_mil.train(spark.createDataFrame([(a, None), (a, "one two"), (b, None)], DOCS), labels)
    assert seen[2][1] == [1, 1] and seen[2][0][0].any() and not seen[2][0][1].any()


def test_token_store_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer
    path = queries.vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = ["It's don't I'LL a'.s x.'s a!!'s q:'re", "<|endoftext|> hi<|startoftext|>a", "áé . ́x", "1234.5,6 a1b2", "̀,́a σς.Σ ΑΣ!x", "a​.b\x85k \x00z"]
    rows = [*EDGE, *enumerate(odd)]
    folder = f"{tmp_path}/store"
    tokenids.write_store(spark.createDataFrame(rows, DOCS), folder, path)
    got = tokenids.read_store(spark, folder, with_ids=True).collect()
    assert [r.start for r in sorted(got, key=lambda r: r.start)] == np.cumsum([0, *(r.n_tokens for r in sorted(got, key=lambda r: r.start))])[:-1].tolist()
    want = sorted((str(d), [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is None, d or 0))
    tokenids.write_store(spark.createDataFrame([], DOCS), f"{tmp_path}/empty", path)
    assert tokenids.read_store(spark, f"{tmp_path}/empty").count() == 0


def test_viterbi_is_best_and_round_trips(spark):
    path = queries.vocabulary("piece_bpe_32k.model")
    m = sentencepieces.model(path)
    ws = sorted("▁" + w for w in ["the", "theatre", "then", "für", "日本\U0001F600", "xqzj", "", "a" * 30, "b▁c", "internationalization"])
    for w, seq in zip(ws, sentencepieces.segment_sorted(m, ws)):
        best = [0.0]
        for j in range(1, len(w) + 1):
            best.append(max([best[i] + m.scores[w[i:j]] for i in range(j) if w[i:j] in m.scores] or [best[j - 1] + m.unknown]))
        score = sum(m.scores[m.pieces[i]] for i in seq if i not in m.byte_id.values())
        unknown = sum(1 for c in w if c not in m.scores)
        assert score + unknown * m.unknown == pytest.approx(best[-1])
    rows = [*EDGE, (1, "a  b\nc \t d "), (2, " lead"), (3, "tail  "), (4, "日本語 für \U0001F600\x00"), (5, "mark▁in")]
    got = {(r.doc_id, r.text): r for r in sentencepieces.encode_decode(spark.createDataFrame(rows, DOCS), path, outputs=("ids", "decoded", "round_trip")).collect()}
    for (d, t), r in got.items():
        assert r.decoded == (t.replace("▁", " ") if t is not None else None)
        assert r.round_trip == ("▁" not in (t or ""))
    assert got[(901, "")].ids == [] and len(got) == len(set(rows))


def test_pipeline_stages_agree_with_their_operators(spark):
    docs = corpus_pipeline._table(spark, SF, "documents")
    extra = docs.selectExpr("*", "'mine' AS score", "7 AS n_words", "source AS sig")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = corpus_pipeline.materialize(stage(spark, extra, SF), name)
        assert out.columns == extra.columns and 0 < out.count() <= extra.count()
        assert {(r.score, r.n_words) for r in out.select("score", "n_words").distinct().collect()} == {("mine", 7)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.round_trip and len(r.ids) == r.n_ids for r in rows)
