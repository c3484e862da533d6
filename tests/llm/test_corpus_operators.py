"""Deduplication, mixing and the pipeline against brute force, and on awkward tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from comparison import connect, duck_rows, spark_rows

from quire.llm import dart_minhash, embedding_dedup, exact_dedup, mixing, substring_dedup
from quire.llm.common import components
from quire.llm.queries import oracle_sql, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, hub string, class_id long, digest string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None)[: 9] if len(r) == 4 else (r[0], r[1], "en", "src1", None, None, None, None, None) for r in rows], DOCS)


def awkward():
    body = " ".join(f"word{i} and more" for i in range(3000))
    return [(1, None), (2, ""), (3, ""), (4, "A b C"), (5, "a B c"), (6, "!!"), (7, body), (8, body), (8, body), (9, body + " end"), (None, "x y z"), (None, "x y z"), (10, "É"), (11, "é")]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql_gives_the_same_rows(spark, data, name):
    cols, rows = spark_rows(queries()[name](spark, data))
    names, want = duck_rows(connect(data), oracle_sql()[name])
    assert cols == names and rows == want


def test_exact_groups_of_awkward_tables(spark):
    rows = awkward()
    got = exact_dedup.exact_groups(docs_of(spark, rows)).collect()
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((i, best[lower(t)], len(groups[lower(t)]), i == best[lower(t)]) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == want
    assert exact_dedup.exact_groups(docs_of(spark, rows).limit(0)).count() == 0
    kept = exact_dedup.drop_copies(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted({r.doc_id for r in kept.where("doc_id is not null").collect()}) == sorted(i for i in best.values() if i is not None)


def test_hash_collisions_do_not_join_texts(spark, monkeypatch):
    """With keys that all collide, texts are still told apart."""
    from pyspark.sql import functions as F

    plain = exact_dedup.recipes
    monkeypatch.setattr(exact_dedup, "unverified_keys", lambda docs, *a: exact_dedup.recipes(docs).selectExpr("cast(conv(hex(substring(recipe, 1, 8)), 16, -10) as long) key").distinct())
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs_of(spark, [(1, "abc"), (2, "ABC"), (3, "abd")])).collect()}
    assert got == {1: 2, 2: 2, 3: 3}
    # texts of one size and one recipe, under null ids
    monkeypatch.setattr(exact_dedup, "recipes", lambda docs, *a: plain(docs, *a).withColumn("recipe", F.unhex(F.lit("00" * 8))))
    monkeypatch.setattr(exact_dedup, "unverified_keys", lambda docs, *a: docs.sparkSession.createDataFrame([(0,)], "key long"))
    got = [r.group_size for r in exact_dedup.exact_groups(docs_of(spark, [(None, "abc"), (None, "abd"), (None, "ABD")])).collect()]
    assert sorted(got) == [1, 2, 2]


def shingle_weights(text):
    words = re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    if not words:
        return Counter([text] if text else [])
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(rows, threshold=0.8):
    weights = {}
    for i, t in rows:
        weights.setdefault(i, shingle_weights(t))
    root = {i: i for i in weights}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(weights)
    for a in ids:
        for b in ids:
            if a < b and weights[a] and weights[b]:
                both = sum((weights[a] & weights[b]).values())
                if both / sum((weights[a] | weights[b]).values()) >= threshold:
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {i: top(i) for i in ids}


def test_near_groups_equal_all_pairs(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in queries()["op2_dart_minhash"](spark, data).collect()}
    assert got == near_components(rows)


def variants(n, seed=5):
    """Near copies of one text with few to many words changed: some links only by way of others."""
    rng = random.Random(seed)
    base = [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = base[:]
        for _ in range(rng.randint(1, 7)):
            words[rng.randrange(150)] = f"new{rng.randrange(10**6)}"
        out.append((100 + i, " ".join(words)))
    return out


def test_large_groups_of_near_copies(spark):
    rows = variants(120) + [(1000 + i, " ".join(f"other{i}x{k}" for k in range(40))) for i in range(10)]
    got = {r.doc_id: r.class_id for r in dart_minhash.near_groups(docs_of(spark, rows)).collect()}
    assert got == near_components(rows)


def test_distances_to_the_hub_rule_out_members(spark):
    """A large component near the hub, and others of which only one is near enough to some of its members."""
    far = {1: 0.0, **{i: 0.01 for i in range(2, 50)}, **{i: 0.15 for i in range(50, 100)}, 200: 0.3, 300: 0.9}
    comp = {i: 1 if i < 100 else i for i in far}
    shared = spark.createDataFrame([(b, 1, i, 10) for b in (7, 8) for i in far], "band long, hub long, node long, weight long")
    compared = spark.createDataFrame([(1, i, 1 - d) for i, d in far.items() if i != 1], "hub long, node long, similarity double")
    labels = spark.createDataFrame([(i, c) for i, c in comp.items()], "node long, comp long")
    left = dart_minhash.open_members(shared, labels, compared, 0.8).collect()
    assert {r.node for r in left} == {*range(50, 100), 200} and {r.band for r in left} == {7}


def test_near_groups_of_awkward_tables(spark):
    rows = [r for r in awkward() if r[0] is not None]
    df = docs_of(spark, awkward())
    got = dart_minhash.near_groups(df).collect()
    assert len(got) == len(awkward())
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == near_components(rows)
    assert dart_minhash.near_groups(df.limit(0)).count() == 0
    assert dart_minhash.drop_near_copies(df).columns == df.columns


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    for share in (0.5, 0.8):
        n = int(600 * share / (1 + share))
        agree = []
        for trial in range(40):
            own = base ^ np.uint64(trial * 977)
            a, b = own[:300], np.concatenate((own[:n], own[:300 - n] ^ np.uint64(1 << 40)))
            sig = dart_minhash.signatures(np.repeat([0, 1], 300), np.concatenate((a, b)), 2)
            agree.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(agree) - n / (600 - n)) < 0.03


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (5, 5)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


# ---- passages


def test_planted_passages(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeiounrstlkdm") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randint(55, 90)) for _ in range(40)]
    rows, holders = [], defaultdict(set)
    for i in range(160):
        own = text(rng.randint(60, 200)).split(" ")
        if i % 2 == 0:
            p = i // 2 % 40
            at = rng.randrange(len(own))
            own[at:at] = [passages[p]]
            holders[p].add(i)
        rows.append((i, " ".join(own)))
    line = "All rights reserved by the owner of this text."
    rows += [(500 + i, f"{line} {text(50)}") for i in range(20)]
    got = substring_dedup.repeated_spans(docs_of(spark, rows)).collect()
    planted = {i for ids in holders.values() for i in ids}
    assert {r.doc_id for r in got} <= planted
    assert len({r.doc_id for r in got}) >= 0.97 * len(planted)
    texts = dict(rows)
    for r in got:
        span = texts[r.doc_id][r.span_start : r.span_end]
        assert any(span in texts[j] for j in planted if j != r.doc_id)
        assert r.is_copy == (r.first_doc_id < r.doc_id)


def test_insertions_shift_boundaries_without_changing_them():
    from quire.llm.textkit import GEAR_WINDOW

    rng = random.Random(2)
    tail = bytes(rng.randrange(97, 123) for _ in range(4000))
    cut = lambda raw: substring_dedup.boundaries(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
    a, b = cut(b"short " + tail), cut(b"a much longer beginning " + tail)
    far = lambda x, n: {int(v) - n for v in x if v - n >= GEAR_WINDOW}
    assert far(a, 6) == far(b, 24) and len(far(a, 6)) > 100


def test_short_and_periodic_passages():
    """Passages of 225 bytes and runs of one word have a chunk that lies in the passage wherever they stand."""
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))

    def shared(passage):
        pair = [(noise(rng.randint(50, 300)) + passage + noise(rng.randint(50, 300))).encode() for _ in range(2)]
        sets = []
        for raw in pair:
            start, end, _ = substring_dedup.cut(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            sets.append({raw[a:b] for a, b in zip(start, end, strict=True) if b - a >= substring_dedup.CHUNK})
        return bool(sets[0] & sets[1])

    assert sum(shared(noise(225)) for _ in range(400)) >= 394
    words = ["a", "ab", "word", "哈", "Straße", "nineteen letters or so"]
    assert all(shared((w + sep) * (300 // len((w + sep).encode()))) for w in words for sep in ("", " ") for _ in range(20))


def test_passages_of_awkward_tables(spark):
    df = docs_of(spark, awkward())
    got = substring_dedup.repeated_spans(df).collect()
    assert {r.doc_id for r in got} == {7, 8, 9}
    assert substring_dedup.repeated_spans(df.limit(0)).count() == 0
    cut = {r.doc_id: r.text for r in substring_dedup.cut_copies(df).where("doc_id in (7, 8, 9, 4)").collect()}
    assert cut[4] == "A b C" and cut[7] == dict(awkward())[7] and len(cut[8]) < 200 and cut[9].endswith("end")
    again = substring_dedup.cut_copies(df)
    assert again.columns == df.columns and again.count() == df.count()


def test_short_texts_and_tails_are_compared(spark):
    noise = [" ".join(f"{w}{i}x{k * 7919 % 1000}" for k in range(40)) for i, w in enumerate("abcdef")]
    rows = [(1, "one short text"), (2, "one short text"), (3, "another"), (4, noise[0] + " and the very same end of it"), (5, noise[1] + " and the very same end of it")]
    got = {(r.doc_id, r.first_doc_id): (r.span_start, r.span_end) for r in substring_dedup.repeated_spans(docs_of(spark, rows), min_span=1).collect()}
    assert got[2, 1] == (0, 14) and not any(d == 3 for d, _ in got)
    assert substring_dedup.repeated_spans(docs_of(spark, rows)).count() == 0
    raw = [t.encode() for _, t in rows]
    start, end, own = substring_dedup.cut(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    covered = np.zeros(sum(map(len, raw)), bool)
    for a, b in zip(start, end, strict=True):
        covered[a:b] = True
    assert covered.all() and set(own) == set(range(5))


def test_cut_text_stays_somewhere(spark):
    """Holders of several parts of a passage: what is cut from one document stays in an earlier one."""
    word = [f"w{i}of{i * i % 977}" for i in range(501)]
    rows = [(2, " ".join(word[1:301])), (5, " ".join(word[1:501])), (9, " ".join(word[201:501]))]
    spans = substring_dedup.repeated_spans(docs_of(spark, rows)).collect()
    assert {(r.doc_id, r.first_doc_id, r.is_copy) for r in spans} == {(2, 2, False), (5, 2, True), (5, 5, False), (9, 2, True), (9, 5, True)}
    cut = {r.doc_id: r.text for r in substring_dedup.cut_copies(docs_of(spark, rows)).collect()}
    assert cut[2] == rows[0][1]
    left = {w for t in cut.values() for w in t.split(" ")}
    assert set(word[1:]) <= left and len(cut[5]) < 0.6 * len(rows[1][1]) and len(cut[9]) < 0.2 * len(rows[2][1])


def test_repeated_spans_equal_brute_force(spark, data):
    """Against all runs of 51 words that two documents share: they lie in spans, and spans are verbatim in the first holder."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    holders = defaultdict(set)
    runs = {d: [(m.start(), m.end()) for m in re.finditer(r"\S+", t)] for d, t in texts.items()}
    for d, t in texts.items():
        for i in range(len(runs[d]) - 50):
            holders[t[runs[d][i][0] : runs[d][i + 50][1]]].add(d)
    want = {d for ids in holders.values() if len(ids) > 1 for d in ids}
    got = queries()["op8_gear_passages"](spark, data).collect()
    found = {r.doc_id for r in got}
    assert len(want) > 20 and len(want & found) >= 0.98 * len(want)
    for r in got:
        assert texts[r.doc_id][r.span_start : r.span_end] in texts[r.first_doc_id] or len(texts[r.doc_id][r.span_start : r.span_end]) > substring_dedup.CHUNK
        chunk = texts[r.doc_id][r.span_start : r.span_end][:40]
        assert chunk in texts[r.first_doc_id] and sum(chunk in t for t in texts.values()) > 1
        assert r.is_copy == (r.first_doc_id < r.doc_id)
    clean = set(texts) - want
    assert len(clean - found) >= 0.93 * len(clean)


# ---- embeddings


def test_links_of_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(600):
        v = base[i % 30] + rng.normal(size=16) * 0.05 * (i % 5)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 30 % 4)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(700)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None, 1.0], 1), (2004, [1.0, 2.0], 1), (2005, [1.0, 2.0], 1), (2006, [], 1), (2007, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, rep int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.similar(df).collect() if r.vec_id is not None}
    good = [(i, np.array(v), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = defaultdict(set)
    for i, v, y in good:
        for j, w, z in good:
            if i < j and y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    assert sum(n for n, _ in got.values()) >= 0.999 * sum(map(len, links.values()))
    assert all(got[i][0] <= len(links[i]) for i in got)
    for i in (2000, 2001, 2002, 2003, 2006, 2007):
        assert got[i] == (0, i)
    assert got[2004] == (1, 2004) and got[2005] == (1, 2004)
    assert embedding_dedup.similar(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_vectors_of_their_own(spark):
    rows = [(1, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 1.0], 1), (3, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (None, [1.0, 0.0], 1)]
    got = embedding_dedup.similar(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert Counter(tuple(r) for r in got) == Counter([(1, 1, 1, True), (1, 0, 1, True), (2, 1, 2, True), (3, 1, 1, False), (3, 1, 2, False), (None, 0, None, True)])


def test_large_groups_of_vectors_in_blocks(spark):
    """One group of 700 vectors that are all alike but not equal, in blocks of 60: each pair counts once."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=24)
    x = base + rng.normal(size=(700, 24)) * 0.11
    rows = [(5000 - i, v.tolist(), "a") for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embedding_dedup.similar(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), block=60).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert 0 < near.min() < near.max() < 700
    assert sum(got[5000 - i].n_links for i in range(700)) >= 0.999 * near.sum()
    assert all(got[5000 - i].n_links <= near[i] for i in range(700))
    assert {r.component_id for r in got.values()} == {4301}


@pytest.mark.parametrize("d,n", [(2, 50), (16, 10_000), (64, 1000), (64, 10**9), (768, 10**6)])
def test_recall_of_keys_at_the_threshold(d, n):
    rng = np.random.default_rng(d)
    v, w = rng.normal(size=(2, 1500, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    w -= (w * v).sum(axis=1, keepdims=True) * v
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    count = embedding_dedup.hashes(d, n)
    a, b = embedding_dedup.keys(v, count), embedding_dedup.keys(0.98 * v + np.sqrt(1 - 0.98**2) * w, count)
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.995


def test_recall_of_hard_pairs(spark):
    """Pairs just above the threshold, the hardest to find."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        w = rng.normal(size=64)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        rows += [(2 * i, v.tolist(), 1), (2 * i + 1, (0.981 * v + np.sqrt(1 - 0.981**2) * w).tolist(), 1)]
    got = embedding_dedup.similar(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert got.where("n_links > 0").count() >= 0.99 * 800


# ---- mixing


def test_budgets_go_to_siblings_first(spark):
    rows = [(i, "w " * n, lang, source) for i, (n, lang, source) in enumerate([(10, "en", "src0"), (1000, "en", "src4"), (10, "fr", "src0"), (1000, "de", "src1"), (500, None, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    own = mixing.leaves(df)
    plan = mixing.budgets(own, ({}, {}, {}), percent=50, epochs=1)
    got = {(r.language, r.source): r.budget for r in plan.collect()}
    total = sum(got.values())
    assert 1260 - 6 <= total <= 1260
    assert got["en", "src0"] == 10 and got["fr", "src0"] == 10 and got["en", "src4"] > 200


def test_many_siblings_in_parts(spark):
    """Budgets of 300 sources with ties, dealt in parts, against a loop."""
    rng = random.Random(6)
    sizes = [rng.choice([1, 2, 2, 5, 40, 300]) for _ in range(300)]
    df = spark.createDataFrame([(i, "w " * n, "en", f"s{i:03d}a") for i, n in enumerate(sizes)], "doc_id long, text string, lang string, source string")
    weight = {f"s{i:03d}a": rng.choice([0, 1, 2, 7]) for i in range(300)}
    got = {r.source: r.budget for r in mixing.budgets(mixing.leaves(df), ({}, {}, weight), percent=30, epochs=1).collect()}
    left, open_, want = sum(sizes) * 30 // 100, [i for i in range(300) if weight[f"s{i:03d}a"]], {}
    for i in sorted(open_, key=lambda i: (sizes[i] / weight[f"s{i:03d}a"], i)):
        level = left / sum(weight[f"s{j:03d}a"] for j in open_ if j not in want)
        if level * weight[f"s{i:03d}a"] <= sizes[i]:
            break
        want[i] = sizes[i]
        left -= sizes[i]
    for i in range(300):
        w = weight[f"s{i:03d}a"]
        assert got[f"s{i:03d}a"] == (0 if not w else want.get(i, int(level * w))), i


def test_weight_zero_excludes(spark):
    """What is excluded gets nothing, at any level, and its share goes to its siblings."""
    rows = [(i, "w " * 100, lang, source) for i, (lang, source) in enumerate([("en", "src0"), ("en", "src4"), ("fr", "src0"), ("de", "src1")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for weights, out in (({}, {}, {"src4": 0}), {("en", "src4")}), (({}, {"en": 0}, {}), {("en", "src0"), ("en", "src4")}), (({"domain1": 0}, {}, {}), {("de", "src1")}), (({"domain0": -1, "domain1": 0}, {}, {}), {(r[2], r[3]) for r in rows}):
        got = {(r.language, r.source): r.budget for r in mixing.budgets(mixing.leaves(df), weights, percent=50, epochs=1).collect()}
        assert all((b == 0) == (k in out) for k, b in got.items())
        assert sum(got.values()) >= min(198, 100 * (4 - len(out)) - 3)
    assert len(mixing.select(df, weights=({}, {}, {"src0": 0})).collect()) == 4


def test_domains_by_name(spark):
    df = spark.createDataFrame([(1, "a", "en", "web"), (2, "b", "en", "books"), (3, "c", "en", None)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.domain for r in mixing.leaves(df, domains={"web": "crawl", "books": "print"}).collect()}
    assert got == {1: "crawl", 2: "print", 3: "none"}


def test_mixing_of_awkward_tables(spark):
    df = docs_of(spark, awkward())
    got = mixing.select(df).collect()
    assert len(got) == len(awkward())
    assert all(0 <= r.copies <= mixing.EPOCHS for r in got)
    assert mixing.select(df.limit(0)).count() == 0
    assert mixing.keep_mixed(df).columns == df.columns
    whole = mixing.select(df, percent=300, epochs=3).where("n_tokens > 0").collect()
    assert {r.copies for r in whole} == {3}


# ---- the pipeline


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    own = docs
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        own = stage(spark, own, data)
        assert own.columns == docs.columns
        own = spark.createDataFrame(own.collect(), docs.schema)
        left.append((name, {r.doc_id for r in own.collect()}))
    known, exact, near, mixed = (ids for _, ids in left)
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    best = {}
    for i in known:
        best[lower(rows[i].text)] = max(i, best.get(lower(rows[i].text), -1))
    assert exact == set(best.values())
    comps = near_components([(i, rows[i].text) for i in exact])
    assert near == {i for i in exact if comps[i] == i}
    assert mixed <= near and len(mixed) >= 0.7 * len(near)
    packed = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in packed} == mixed


def test_stages_of_an_awkward_table(spark, data):
    """Nulls in every column, empty and very long texts, repeated rows, and columns that clash with the stages' own."""
    import corpus_pipeline

    rows = [(*r, "en" if r[0] is None or r[0] % 3 else None, None if r[0] == 5 else "src1", None, 1, "x", 2, None) for r in awkward()]
    own = spark.createDataFrame(rows, DOCS)
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, own, data)
        assert out.columns == own.columns
        got = out.collect()
        own = spark.createDataFrame(got, own.schema) if got else own.limit(0)
        ids[name] = Counter(r.doc_id for r in got)
    assert not {1, 2, 3, 6} & set(ids["language_id"]) and ids["language_id"][8] == 2 and ids["language_id"][None] == 2
    assert ids["exact_dedup"][8] == 2 and 7 not in ids["exact_dedup"] and 4 not in ids["exact_dedup"]
    assert ids["near_dedup"][8] == 2 and 9 not in ids["near_dedup"] and ids["near_dedup"][None] == ids["exact_dedup"][None]
    packed = corpus_pipeline.STAGES[-1][1](spark, own, data).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == ids["mixing"]


def test_pipeline_of_an_empty_table(spark, data):
    import corpus_pipeline

    own = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        own = stage(spark, own, data)
    assert own.count() == 0
