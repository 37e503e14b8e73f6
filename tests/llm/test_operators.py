"""The operators against brute-force versions and libraries, on small tables with awkward rows."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veritab.llm import bagminhash, bpe, byte_bpe, gated_lm, hnsw, line_rules, mixing, nbsvm, sharding, token_count, toxicity

AWKWARD = [None, "", " \n\t ", "one", "the cat sat on the mat.", "the cat sat on the mat.", "x " * 30_000, "İstanbul ΑΣ ﬁ é", "<|endoftext|> it's", "a\x1cb\x85c　d", "Zeile eins.\nZeile eins.\nHome | About | Help | Us"]


def documents(spark, texts=AWKWARD, **extra):
    rows = [(i if i != 3 else None, t, ["src1", None, "src0"][i % 3]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # names that operators add themselves
    return df.withColumns({c: F.lit("mine") for c in ("n_tokens", "size", "taken", "score", "ids", "position", "shard", "kept", "node")})


def empty(spark):
    return documents(spark).filter("false")


def test_token_counts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = token_count.token_counts(documents(spark), P.path("word_bpe_49k.json")).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(library.encode(t or "", add_special_tokens=False).ids) for t in AWKWARD)
    assert token_count.count_tokens(documents(spark), P.path("word_bpe_49k.json")).filter("over_limit").count() == 1
    assert token_count.token_counts(empty(spark), P.path("word_bpe_49k.json")).count() == 0


def test_state_maps():
    counts = token_count.counter(P.path("word_bpe_49k.json"))
    random.seed(3)
    for _ in range(300):
        text = "".join(random.choice(["ab", " ", "'s", "!!", "\n", "é", "7", "<|endoftext|>", "words"]) for _ in range(30))
        assert counts.count(text, chunk=random.randint(1, 12)) == counts.count(text)
        maps = [counts.state_map(text[i : i + 7]) for i in range(0, len(text), 7)]
        left = maps[0]
        for m, prefix in zip(maps[1:], counts.scan(maps)[1:], strict=True):
            left = counts.compose(left, m)
            assert left == prefix


def encoding():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark):
    library = encoding()
    got = byte_bpe.round_trip(documents(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    expected = []
    for t in AWKWARD:
        ids = library.encode_ordinary(t or "")
        expected.append((len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(expected)
    coded = byte_bpe.encode(documents(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    back = byte_bpe.decode(coded, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
    assert byte_bpe.round_trip(empty(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_edits():
    table = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    random.seed(5)
    held = bpe.EditableEncoding(table, b"thermodynamically")
    for _ in range(60):
        word = held.word.encode("latin-1")
        a = random.randint(0, len(word))
        b = random.randint(a, min(len(word), a + 3))
        held.replace(a, b, random.choice([b"the", b"in", b"", b"q", b"ation"]))
        held.append(random.choice([b"", b"s", b"ing"]))
        assert held.ids() == table.encode_by_merging(held.word)


def test_validity_of_pairs():
    table = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    random.seed(6)
    for _ in range(1500):
        a, b = random.randrange(50_000), random.randrange(50_000)
        assert table.valid(a, b) == (table.encode_by_merging(table.text[a] + table.text[b]) == [a, b])


def test_line_rules(spark):
    got = {r["doc_id"]: r for r in line_rules.judge_documents(documents(spark), keep_text=True).collect()}
    assert got[10]["n_dup_lines"] == 1 and got[10]["cleaned"] == "Zeile eins.\nZeile eins." and not got[10]["kept"]
    assert got[6]["n_repeat_words"] == 30_000 and got[6]["base_failed"]
    assert got[0]["n_words"] == 0 and got[0]["base_failed"]
    assert line_rules.judge_documents(empty(spark)).count() == 0
    assert line_rules.clean(documents(spark)).columns == documents(spark).columns


def test_repeated_words_by_brute_force():
    random.seed(7)
    for _ in range(200):
        words = [random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(0, 40))]
        at = defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i : i + 5])].append(i)
        covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
        assert line_rules.repeated_words(words) == len(covered)


def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        used, room = 1, middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("copies", [1, 40])
def test_sharding(spark, copies):
    random.seed(8)
    texts = [None, ""] + ["x" * random.randint(0, 300) + str(i % 150) for i in range(400)] + ["hot" * 30] * copies
    placed = sharding.shard_documents(documents(spark, texts), 7).collect()
    assert len(placed) == len(texts)
    by_shard, by_group, groups = defaultdict(list), defaultdict(set), Counter()
    for r in placed:
        by_shard[r["shard"]].append(r)
        by_group[r["group_key"]].add(r["shard"])
        groups[r["group_key"]] += r["size"]
    assert all(len(s) == 1 for s in by_group.values())
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by_shard.values())
    assert max(sum(r["size"] for r in rows) for rows in by_shard.values()) == brute_capacity([groups[k] for k in sorted(groups)], 7)
    assert {r["text_crc32"] for r in placed} == {zlib.crc32((t or "").encode()) for t in texts}
    assert sharding.shard_documents(empty(spark), 7).count() == 0


def brute_targets(sizes, weights, share=1.5):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    stop, target, left = {n: 2 * sizes[n] for n in names}, {}, share * sum(sizes.values())
    free = set(names)
    while free:
        level = left / sum(w[n] for n in free)
        over = {n for n in free if level * w[n] > stop[n]}
        if not over:
            return target | {n: level * w[n] for n in free}
        for n in over:
            target[n] = stop[n]
            left -= stop[n]
        free -= over
    return target


def test_mixing(spark):
    random.seed(9)
    rows = [(i, " ".join(["w"] * random.randint(0, 60)), random.choice(["b", "a", "c", None, "hot", "hot", "hot"])) for i in range(300)] + [(300, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for (_, text, source), r in zip(rows, sorted(got, key=lambda r: r["doc_id"]), strict=True):
        n = len((text or "").split())
        assert r["size"] == n and 0 <= r["taken"] <= 2 * n
        sizes[source] += n
        taken[source] += r["taken"]
        target[source] = r["target"]
    expected = brute_targets(sizes, (3, 1, 2))
    assert {k: pytest.approx(v) for k, v in expected.items()} == target
    assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    assert mixing.mix(documents(spark).filter("false")).count() == 0
    order = mixing.training_order(documents(spark))
    assert order.columns == documents(spark).columns


def test_inverse_demand(spark):
    slope, target = F.col("s"), F.lit(100.0)
    df = spark.createDataFrame([(s, t / 10) for s in (0.5, -0.5, 0.0) for t in range(11)], "s double, t double")
    asked = target * ((1 - slope) * F.col("t") + slope * F.col("t") * F.col("t"))
    assert df.filter(F.abs(mixing.inverse_demand(asked, target, slope) - F.col("t")) > 1e-9).count() == 0


def bags(texts):
    return [Counter(zip(*[(t or "").split()[k:] for k in range(5)])) if len((t or "").split()) >= 5 else Counter([tuple((t or "").split())]) for t in texts]


def similarity(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


@pytest.mark.parametrize("members", [512, 3])
def test_near_groups(spark, monkeypatch, members):
    # with few members in a block, open buckets are worked through in many
    monkeypatch.setattr(bagminhash, "MEMBERS", members)
    random.seed(10)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "a b", "a  b"]
    for _ in range(12):
        base = [random.choice(words) for _ in range(random.choice([20, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(random.randint(0, 6)):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy * random.choice([1, 1, 2])))
    texts += [texts[6]] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_groups(docs).collect()}
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    b = bags(texts)
    for i in range(len(texts)):
        for j in range(i):
            if similarity(b[i], b[j]) >= 0.8:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    assert got == {i: find(i) for i in range(len(texts))}
    assert sorted(r["doc_id"] for r in bagminhash.first_of_groups(docs).collect()) == sorted(set(got.values()))
    assert bagminhash.near_groups(empty(spark)).count() == 0


def test_large_open_buckets(spark, monkeypatch):
    """A chain of texts, each similar to the next only, and many that share bands with it, over many blocks."""
    monkeypatch.setattr(bagminhash, "MEMBERS", 16)
    random.seed(20)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words)]
    for i in range(300):
        # one word in thirty is new, so that a text is like its neighbours and unlike those far off
        words = [w if (k + i) % 30 else f"x{i}_{k}" for k, w in enumerate(words)]
        texts.append(" ".join(words))
    texts += [" ".join(f"w{random.randrange(40)}" for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_groups(docs).collect()}
    b, parent = bags(texts), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if similarity(b[i], b[j]) >= 0.8:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    assert got == {i: find(i) for i in range(len(texts))}


def test_clashing_names_and_long_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "a b c d e f"), (-1, "other"), (None, "else")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("mine") for c in ("_id", "_node", "_keeper", "_text", "c0", "bucket", "n")})
    kept = bagminhash.first_of_groups(docs)
    assert kept.columns == docs.columns and kept.filter("_id <> 'mine' OR _node <> 'mine'").count() == 0
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, -1, None])


def test_null_and_repeated_ids(spark):
    random.seed(19)
    text = lambda: " ".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))
    one, two, three, four, five = (text() for _ in range(5))
    # three is a near copy under two ids; id 7 has a copy of it and a text of its own
    rows = [(None, one), (None, two), (None, two), (3, three), (7, three + " z"), (7, four), (8, five), (8, five), (8, one), (9, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = bagminhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter([(None, one), (None, two), (3, three), (7, four), (8, five), (None, None)])
    # the classes by their sizes: unrelated texts share neither class_id nor text_id
    groups = bagminhash.near_groups(docs).collect()
    sizes = Counter(r["class_id"] for r in groups)
    assert sorted(sizes.values()) == [1, 2, 2, 2, 2, 2] and all(r["class_size"] == sizes[r["class_id"]] for r in groups)
    assert {r["class_id"] for r in groups} >= {-1, 3, 7, 8} and len({r["text_id"] for r in groups}) == 7


def test_digits_rarely_rule_out_similar_texts():
    apart = (1 - bagminhash.SIMILAR) * 15 / 16
    n, most = bagminhash.SIZE, bagminhash.MOST_DIGITS
    assert sum(math.comb(n, k) * apart**k * (1 - apart) ** (n - k) for k in range(most + 1, n + 1)) < 1e-8
    # two copies whose digits, set by hand, differ in 57 places
    digits = np.zeros((2, n // 2), np.uint8)
    digits[1, :57] = 1
    columns = {c: [0, 0] for c in ("bucket", "first", "second", "block", "band")} | {"node": [1, 2], "root": [1, 2], "n": [3, 3], "digits": digits.view(np.int64).tolist(), "bands": [[5] * bagminhash.BANDS] * 2, "windows": [[7, 8, 9]] * 2}
    assert bagminhash.links_of(pa.table(columns)) == [(1, 2)]


def test_signatures_are_unbiased():
    random.seed(11)
    off = []
    for _ in range(150):
        base = [random.choice("abcdefghijklmnop") for _ in range(random.choice([12, 60, 200]))]
        other = list(base)
        for _ in range(random.randint(0, 6)):
            other[random.randrange(len(other))] = random.choice("abcdefghijklmnop")
        a, b = " ".join(base * random.choice([1, 3])), " ".join(other * random.choice([1, 3]))
        s = bagminhash.signatures([bagminhash.windows(a.encode()), bagminhash.windows(b.encode())])
        off.append((s[0] == s[1]).mean() - similarity(*bags([a, b])))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.05


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in bagminhash.components(chain).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_nearest(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[600:] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (950, [0.0] * 16), (1000, [float("nan")] * 16), (1050, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in hnsw.nearest(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    wide = x.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    hits = 0
    assert set(got) == set(range(0, 700, 50))
    for q in got:
        sims = np.round(unit @ unit[q], 12)
        order = [i for i in np.lexsort([np.arange(700), -sims]) if i != q][:5]
        hits += len(set(order) & set(got[q]))
        if q >= 600:
            assert got[q] == order
    assert hits >= 0.9 * 5 * len(got)
    assert hnsw.nearest(df.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def brute_nearest(rows, queries, k):
    """Ids of the k nearest of (id, vector), best first, ties to smaller ids."""
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for q in queries:
        sims = np.round(unit @ unit[np.flatnonzero(ids == q)[0]], 13)
        out[q] = [i for i in ids[np.lexsort([ids, -sims])].tolist() if i != q][:k]
    return out


@pytest.mark.parametrize("clusters", [0, 40])
def test_nearest_of_many_shards(spark, monkeypatch, clusters):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 3000)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 128)
    rng = np.random.default_rng(21)
    n = 20_000
    x = rng.normal(size=(n, 24))
    if clusters:
        # half of all rows are of one cluster
        x = 0.3 * x + rng.normal(size=(clusters, 24))[np.minimum(rng.integers(0, 2 * clusters, n), clusters - 1)]
    rows = list(enumerate(x.astype(np.float32).tolist()))
    found = hnsw.entries(spark.createDataFrame(rows, "id long, vector array<double>"), 6)
    routes = hnsw.fit_routes(found, 5)
    assert routes[24].splits.sum() >= 5
    if clusters:
        assert routes[24].asked < len(routes[24].centres) and routes[24].splits.max() > 1
    got = defaultdict(list)
    for r in hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    expected = brute_nearest(rows, range(0, n, 50), 5)
    assert set(got) == set(expected) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(expected[q])) for q in expected]) / 5 >= 0.9


@pytest.mark.parametrize("scale", [1e200, 1e-200, 1e308, 5e-324 * 2**20])
def test_nearest_of_extreme_components(spark, scale):
    """Squares that overflow or vanish; each row at its own scale has the cosine that it has at 1."""
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 2.0]), (1, [scale, scale]), (2, [scale, 0.0]), (3, [0.0, -scale]), (4, [2.0, 1.0])]
    rows += [(i, (np.sign(x) * scale * np.array([1.0, 0.5])).tolist()) for i, x in enumerate(rng.normal(size=4), 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in hnsw.nearest(df, F.col("vec_id") == 0, 8).orderBy("rank").collect()]
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    cosine = {i: float(unit[0] @ v / (np.linalg.norm(unit[0]) * np.linalg.norm(v))) for i, v in unit.items() if i}
    # directions that are equal but for the last bit may stand in either order
    assert [i for i, _ in sorted(got, key=lambda x: (-round(x[1], 12), x[0]))] == sorted(cosine, key=lambda i: (-round(cosine[i], 12), i))
    assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
    assert [s for _, s in got] == pytest.approx([cosine[i] for i, _ in got], abs=1e-15)


def test_nearest_keeps_precision_and_ties(spark):
    """Double components that floats can't tell apart; scaled copies of one vector; two lengths; repeated ids; clashing names."""
    rng = np.random.default_rng(22)
    base = rng.normal(size=8)
    rows = [(i, (base + 1e-9 * rng.normal(size=8)).tolist()) for i in range(20)]
    rows += [(100 + i, (2.0 ** (i % 5) * np.arange(1.0, 9.0)).tolist()) for i in range(60)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(9)]
    rows += [(50, [1.0] * 8), (50, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit("mine"), "dim": F.lit("mine"), "shard": F.lit("mine")})
    got = defaultdict(list)
    for r in hnsw.nearest(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    by_id = dict(rows)
    for q in (0, 50, 100, 150):
        want = brute_nearest([(i, v) for i, v in rows if len(v) == 8 and (i != 50 or q == 50)][: len(rows)], [q], 5)[q]
        if q in (0, 50):
            # the neighbours of 0 are alike to the last bit of a double, so sums in another order may rank them otherwise
            cosine = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
            assert [s for _, s in got[q]] == pytest.approx([cosine(by_id[q], by_id[i]) for i in want], abs=4e-16)
            assert [s for _, s in got[q]] == pytest.approx([cosine(by_id[q], by_id[i]) for i, _ in got[q]], abs=4e-16)
        else:
            assert [i for i, _ in got[q]] == want
        for i, score in got[q]:
            a, b = np.array(by_id[q]), np.array(by_id[i])
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-15)
    # ties of all scaled copies go to the smallest ids
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105] and [i for i, _ in got[150]] == [100, 101, 102, 103, 104]
    assert len(got[200]) == 5 and all(i > 200 for i, _ in got[200]) and len(got[50]) == 5


def test_network_gradient():
    counts = Counter({f"w{i}".encode(): 1000 - i for i in range(900)}) + Counter({gated_lm.END: 700})
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    v = gated_lm.Vocabulary([w for w, _ in top], np.array([n for _, n in top]), sum(counts.values()) + 50, len(counts) + 20)
    net = gated_lm.Network(v)
    net.flat = net.flat.astype(np.float64)
    net.p = net.views(net.flat)
    rng = np.random.default_rng(0)
    symbols = lambda: rng.choice([*range(v.own), v.rest], (6, 5))
    inputs, targets, fresh, real, h0 = symbols(), symbols(), rng.random((6, 5)) < 0.2, rng.random((6, 5)) < 0.9, rng.normal(size=(gated_lm.HIDDEN, 5))

    def loss():
        h, total = h0, 0.0
        for t in range(6):
            h = net.step(net.inputs(inputs[t : t + 1])[0], net.cleared(h, fresh[t]))
            total -= net.outputs(h[:, real[t]], targets[t][real[t]])[0].sum()
        return total

    gradient = np.zeros(net.size)
    net.train_window(inputs, targets, fresh, real, h0, gradient)
    for k in rng.choice(np.flatnonzero(gradient), 80):
        old = net.flat[k]
        net.flat[k] = old + 1e-5
        above = loss()
        net.flat[k] = old - 1e-5
        below = loss()
        net.flat[k] = old
        assert gradient[k] == pytest.approx((above - below) / 2e-5, rel=1e-3, abs=1e-5)


def test_network_sums_to_one():
    counts = {b"a": 50, b"b": 30, b"c": 5, gated_lm.END: 10}
    v = gated_lm.Vocabulary(list(counts), np.array(list(counts.values())), 95, 4)
    net = gated_lm.Network(v)
    total = sum(np.exp(net.score([np.array([s])])[0]) for s in [*range(v.own), v.rest])
    assert total == pytest.approx(1.0, abs=1e-4)
    whole = [np.array([0, 1, 0, 2, 3] * 20), np.array([1]), np.array([2, 3])]
    assert net.score(whole) == pytest.approx([net.score([w])[0] for w in whole], rel=1e-5)


def test_network_tells_rarer_words_apart():
    """Words beyond the 256 most frequent come in pairs; the first of a pair predicts the second."""
    words = [b"w%03d" % i for i in range(600)]
    v = gated_lm.Vocabulary([gated_lm.END, *words], np.array([3000, *[1000] * 600]), 603_000, 601)
    assert v.own == 601 and len({int(s) for s in v.symbols(v.read(b" ".join(words))[0])}) == 601
    assert len(gated_lm.Vocabulary([gated_lm.END, *words * 40], np.array([3000, *[25] * 24000]), 603_000, 24001).class_counts) > len(v.class_counts)
    rng = np.random.default_rng(1)
    text = lambda: np.append(np.stack([a := 299 + 2 * rng.integers(0, 150, 40), a + 1], 1).ravel(), v.rank[gated_lm.END])
    trainer = gated_lm.Trainer(gated_lm.Network(v))
    before = trainer.network.score([t := text()])[0]
    for _ in range(60):
        for _ in range(100):
            trainer.add(text())
        trainer.finish()
    # the second of a pair costs little; by counts alone a text is no better than 81 draws out of 150 pairs
    assert trainer.network.score([t])[0] > before + 0.2 * 80 * np.log(300)


def test_language_model(spark):
    random.seed(13)
    rows = [(i, " ".join(random.choice(["red", "Blue", "green"]) + (" fish" if random.random() < 0.9 else " rare%d" % random.randrange(99)) for _ in range(20))) for i in range(120)] + [(None, None), (500, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = gated_lm.score_documents(docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update((t or "").lower().split())
            counts[""] += 1
    total, kinds = sum(counts.values()), len(counts)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in rows:
        tokens = [*(t or "").lower().split(), ""]
        r = by_id[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total, held(i))
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens))
        assert np.isfinite(r["score"]) and r["score"] < 0
    assert gated_lm.score_documents(docs.filter("false")).count() == 0


def test_quality_classifier(spark):
    random.seed(14)
    good = lambda: " ".join(random.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(40)) + "."
    bad = lambda: " ".join(random.choice(["BUY!!", "NOW!!", "the###", "win$$$"]) for _ in range(40))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(240)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(240)] + [(7, None), (None, 1)], "doc_id long, quality int")
    model = nbsvm.train(docs, labels)
    got = {r["doc_id"]: r for r in nbsvm.score_quality(spark, docs, model).collect()}
    assert all(got[i]["predicted"] == (0 if i % 4 == 0 else 1) for i in range(240))
    assert 0 <= got[900]["score"] <= 1 and got[900]["score"] == got[901]["score"]
    assert {r["doc_id"] for r in nbsvm.keep_good(spark, docs, model).collect()} >= {i for i in range(240) if i % 4}
    nothing = nbsvm.train(docs, labels.filter("false"))
    assert nbsvm.score_quality(spark, docs, nothing).filter("score <> 0.5").count() == 0


def brute_tables(counts):
    """The ratio tables by recursion over dictionaries."""
    level, shared = Counter(g[1:] for g in counts if len(g) > 1), Counter()
    while level:
        shared.update(level)
        level = Counter(g[1:] for g in level if len(g) > 1)
    total, kinds = Counter(), Counter()
    for g, n in shared.items():
        total[g[:-1]] += n
        kinds[g[:-1]] += 1
    alphabet = max(2, kinds[""] + 1)

    def backoff(g):
        if not g:
            return 1 / alphabet
        return max(shared[g] - 0.75, 0) / total[g[:-1]] + 0.75 * kinds[g[:-1]] / total[g[:-1]] * backoff(g[1:])

    give = lambda n: toxicity.DISCOUNTS[min(n, 3)]
    sums, free = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0.0, 0.0])
    for g, pair in counts.items():
        for c in (0, 1):
            sums[g[:-1]][c] += pair[c]
            free[g[:-1]][c] += give(pair[c])
    own = {}
    for g, pair in counts.items():
        if max(pair) > 1:
            s, f = sums[g[:-1]], free[g[:-1]]
            p = [(pair[c] - give(pair[c]) + f[c] * backoff(g[1:])) / s[c] if s[c] else backoff(g[1:]) for c in (0, 1)]
            own[g] = np.log(p[1]) - np.log(p[0])
    return own


def test_toxicity_tables():
    random.seed(15)
    counts = defaultdict(lambda: [0, 0])
    for _ in range(600):
        for g in toxicity.grams("".join(random.choice("abcö") for _ in range(random.randint(1, 12)))):
            counts[g][random.randrange(2)] += 1
    names = list(counts)
    grams, ratios, _, _ = toxicity.ratio_tables(pa.array(names), np.array([counts[g][0] for g in names]), np.array([counts[g][1] for g in names]))
    expected = brute_tables(counts)
    assert set(grams) == set(expected) and ratios == pytest.approx([expected[g] for g in grams])


def test_toxicity(spark):
    random.seed(16)
    plain = ["tree", "river", "stone", "cloud", "window", "garden", "letter", "paper"]
    rows = []
    for i in range(400):
        words = [random.choice(plain) + random.choice(["", "s", "ing"]) for _ in range(60)]
        if i % 5 == 0:
            for w in random.sample(["fool", "fools", "foolish", "wretch", "wretched"], 3):
                words[random.randrange(60)] = w
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(spark, docs, *toxicity.train(docs, labels)).collect()}
    held = [r for i, r in got.items() if r["held_out"] and i < 400]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held]) > 0.95
    assert got[900]["score"] == got[901]["score"]
    assert toxicity.score_toxicity(spark, docs, *toxicity.train(docs, labels.filter("false"))).count() == 402


def test_long_document_is_scored_in_few_windows(monkeypatch):
    words = [b"%d" % i for i in range(300)]
    v = gated_lm.Vocabulary([gated_lm.END, *words], np.array([3000, *[1000] * 300]), 303_000, 301)
    net, rng, calls = gated_lm.Network(v), np.random.default_rng(3), []
    outputs = gated_lm.Network.outputs
    monkeypatch.setattr(gated_lm.Network, "outputs", lambda self, *a: calls.append(1) or outputs(self, *a))
    texts = [np.append(rng.integers(1, 301, n), 0) for n in (5000, 3, 700, 0)]
    got = net.score(texts)
    assert len(calls) <= 4
    monkeypatch.setattr(gated_lm, "WIDE", 1)
    monkeypatch.setattr(gated_lm, "STRETCH", 1)
    assert np.allclose(got, [net.score([t])[0] for t in texts], rtol=1e-6)


def test_tokens_are_those_of_bytes():
    """Texts are split in bulk, at the same white space and with the same letters as by bytes; each ends with END."""
    rng = random.Random(5)
    parts = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x1f", b"\x85", b"\xc2\x85", b"\xc2\xa0", b"\x00", b"A", b"z", b"\xc3\x84", b"\xe2\x80\x83"]
    texts = [None, b"", b" ", b"\n\n", *(b"".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(2000))]
    words, sizes = gated_lm.tokens_of(pa.chunked_array([pa.array(texts[:7], pa.binary()), pa.array(texts[7:], pa.binary())]))
    wanted = [[*(t or b"").lower().split(), gated_lm.END] for t in texts]
    assert words.to_pylist() == [w for ws in wanted for w in ws] and sizes.tolist() == [len(ws) for ws in wanted]
    v = gated_lm.Vocabulary([gated_lm.END, b"a", b"z"], np.array([9, 5, 3]), 30, 20)
    ranks, _, beyond = v.read_all(pa.chunked_array([pa.array(texts, pa.binary())]))
    assert ranks.tolist() == [v.rank.get(w, -1) for ws in wanted for w in ws] and beyond.to_pylist() == [w for ws in wanted for w in ws if w not in v.rank]
