"""What SQL cannot express, against plain versions that share no code with the operators' main path."""

import hashlib
import math
import random
import struct
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import bags, brute_tables, brute_targets, encoding, similarity
from veritab.llm import bagminhash, gated_lm, line_rules, mixing, nbsvm, toxicity
from veritab.llm.frames import written

# --- quality classifier ------------------------------------------------------------------------------------------


def test_dual_optimum_and_ratios():
    """Against projected gradient ascent on the dual, and log-count ratios counted feature by feature."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12)) for _ in range(60)]
    y = np.array([int(len(set(r.tolist()) & set(range(12))) >= 4) for r in rows])
    y[:6] ^= 1
    assert 10 < y.sum() < 50
    model = nbsvm.fit(rows, y, {0: 60, 1: 60}, cost=0.5, epochs=4000)
    out = np.arange(60) % 5 == 4
    counts = np.ones((2, 1 << nbsvm.BITS))
    for r, c in zip([r for r, o in zip(rows, out, strict=True) if not o], y[~out], strict=True):
        for f in r:
            counts[c, f] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    seen = np.unique(np.concatenate([r for r, o in zip(rows, out, strict=True) if not o]))
    assert model.square[seen] == pytest.approx(ratio[seen] ** 2, rel=1e-5)
    used = [r for r, o in zip(rows, out, strict=True) if not o]
    x = np.zeros((len(used), 41))
    for i, r in enumerate(used):
        x[i, r] = ratio[r] / math.sqrt((ratio[r] ** 2).sum())
        x[i, 40] = 1.0
    sign = np.where(y[~out] == 1, 1.0, -1.0)
    n = np.bincount(y, minlength=2)
    weight = np.array([60 / n[0], 60 / n[1]])[y]
    cost = 0.5 * (weight * 60 / weight.sum())[~out]
    gram, dual = (x * sign[:, None]) @ (x * sign[:, None]).T, np.zeros(len(used))
    step = 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(60_000):
        dual = np.clip(dual + step * (1 - gram @ dual), 0, cost)
    w = (dual * sign) @ x
    assert model.bias == pytest.approx(w[40], abs=5e-3)
    assert model.weight[:40] == pytest.approx(w[:40] * ratio[:40], abs=5e-3)
    margins = np.array([(model.weight[r].sum() / math.sqrt(model.square[r].sum())) + model.bias for r in rows])
    assert [model.margin(r) for r in rows] == pytest.approx(margins, abs=1e-5)
    score = model.score(margins)
    assert np.all((score > 0) & (score < 1)) and np.all(np.diff(score[np.argsort(margins)]) >= 0)


def test_long_text_and_clashing_names(spark):
    text = "word " * 300_000 + "end."
    docs = spark.createDataFrame([(1, text), (1, "word end."), (None, None)], "doc_id long, text string").withColumns({"score": F.lit("x"), "label": F.lit("y"), "held_out": F.lit("z")})
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)], "doc_id long, quality int, toxic int")
    quality = nbsvm.score_quality(spark, docs, nbsvm.train(docs, labels)).collect()
    toxic = toxicity.score_toxicity(spark, docs, *toxicity.train(docs, labels)).collect()
    assert len(quality) == len(toxic) == 3 and all(0 <= r["score"] <= 1 for r in [*quality, *toxic])
    assert nbsvm.score_quality(spark, docs.filter("false"), nbsvm.train(docs, labels)).count() == 0
    assert toxicity.score_toxicity(spark, docs.filter("false"), *toxicity.train(docs, labels)).count() == 0


def test_hot_id_gives_one_labelled_row(spark):
    from veritab.llm.learning import labelled_sample

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    sample, _ = labelled_sample(docs, labels, "quality", 3, 3, 100)
    assert sorted(r["doc_id"] for r in sample.collect()) == [1, 2]


# --- toxicity ----------------------------------------------------------------------------------------------------


def toy_tables():
    random.seed(31)
    counts = defaultdict(lambda: [0, 0])
    for _ in range(800):
        for g in toxicity.grams("".join(random.choice("abcde") for _ in range(random.randint(1, 9)))):
            counts[g][random.randrange(2)] += random.randint(1, 3)
    names = list(counts)
    import pyarrow as pa

    return counts, toxicity.ratio_tables(pa.array(names), np.array([counts[g][0] for g in names]), np.array([counts[g][1] for g in names]))


@pytest.mark.parametrize("length", [1, 31, 32, 33, 63, 64, 65, 1000])
def test_words_are_judged_whole(length):
    """A word's units sum to the difference of all its characters, whatever its length."""
    counts, tables = toy_tables()
    own = brute_tables(counts)
    sums, free = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0.0, 0.0])
    for g, pair in counts.items():
        for c in (0, 1):
            sums[g[:-1]][c] += pair[c]
            free[g[:-1]][c] += toxicity.DISCOUNTS[min(pair[c], 3)]

    def other(context):
        s = [free[context][c] / sums[context][c] if context in sums and sums[context][c] else 1.0 for c in (0, 1)]
        return math.log(s[1]) - math.log(s[0])

    random.seed(length)
    word = "".join(random.choice("abcde") for _ in range(length))
    marked = toxicity.START + word + toxicity.END
    expected = 0.0
    for i in range(1, len(marked)):
        gram = marked[max(0, i - toxicity.ORDER + 1) : i + 1]
        expected += own[gram] if gram in own else other(gram[:-1])
    units = toxicity.WordDifferences(tables)[word.encode()]
    assert len(units) == max(1, -(-length // toxicity.UNIT)) and sum(units) == pytest.approx(expected)
    mean, passage, top, size = toxicity.evidence(word.encode(), toxicity.WordDifferences(tables))
    assert mean == pytest.approx(expected / len(units)) and size == pytest.approx(math.log(len(units)))
    assert passage >= mean - 1e-9 and top >= mean - 1e-9


def test_two_models_in_one_session(spark):
    """A worker that is used again must not keep the model of before."""
    docs = spark.createDataFrame([(i, ("fool " if i % 2 else "tree ") * 5 + "river") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", 1 - F.col("toxic"))

    def scores(which):
        return {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(spark, docs, *toxicity.train(docs, which)).collect()}

    first, second, again = scores(labels), scores(turned), scores(labels)
    assert first == again and all(first[i] != second[i] for i in first)


# --- language model ----------------------------------------------------------------------------------------------


def plain_log10(v, flat, words):
    """log10 probability of a text by the network's equations, token by token and softmax by softmax."""
    net = gated_lm.Network(v, flat)
    p, size = {k: x.astype(float) for k, x in net.p.items()}, gated_lm.HIDDEN
    sigmoid = lambda a: 1 / (1 + np.exp(-a))

    def logp(logits, i):
        return logits[i] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()

    h, before, total = np.zeros(size), v.rank.get(gated_lm.END, v.rest), 0.0
    for w in [*words, gated_lm.END]:
        x = p["w"].reshape(-1, size)[before]
        gx, gh = p["i"] @ x + p["ib"][:, 0], p["u"] @ h
        z, r = sigmoid(gx[:size] + gh[:size]), sigmoid(gx[size : 2 * size] + gh[size : 2 * size])
        n = np.tanh(gx[2 * size :] + r * gh[2 * size :])
        h = (1 - z) * n + z * h
        symbol = v.rank.get(w, v.rest)
        leaf, place = divmod(symbol, gated_lm.LEAF)
        kind = v.class_by_leaf[leaf]
        group = int(np.searchsorted(v.group_starts, kind, "right")) - 1
        for name, low, high, i in (("g", 0, len(v.group_counts), group), ("c", v.group_starts[group], v.group_starts[group + 1], kind), ("l", v.class_starts[kind], v.class_starts[kind + 1], leaf)):
            total += logp(p[name][low:high] @ h + p[name + "b"][low:high, 0], i - low)
        total += logp(p["w"][leaf] @ h + p["wb"][leaf], place)
        before = symbol
    return total / math.log(10)


def corpus(spark, seed):
    random.seed(seed)
    rows = [(i, " ".join(random.choice(["red", "Blue", "green", "rare%d" % random.randrange(60)]) for _ in range(random.choice([3, 20, 90])))) for i in range(90)] + [(None, None), (500, ""), (7, "twice twice"), (7, "twice twice")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "model": F.lit(2.0)})


def test_whole_score(spark, monkeypatch):
    """Head and rest of the vocabulary, state through whole documents, and words beyond the head by their counts."""
    monkeypatch.setattr(gated_lm, "HEAD", 20)
    rows, docs = corpus(spark, 41)
    training = docs.select("doc_id", "text").filter(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10, F.lit(-1)) != 0)
    counts = written(gated_lm.count_words(training), "word-counts")
    v = gated_lm.head_of(counts)
    assert v.own == 20 and v.rest_distinct > 20
    flat = gated_lm.train(training, v)
    n = Counter()
    for i, t in rows:
        if i is None or crc32(str(i).encode()) % 10:
            n.update([*(t or "").lower().split(), ""])
    rest = sum(c for w, c in n.items() if w.encode() not in v.rank)
    expected = []
    for i, t in rows:
        words = [w.encode() for w in (t or "").lower().split()]
        score = plain_log10(v, flat, words)
        for w in [*words, b""]:
            if w not in v.rank:
                score += math.log10(n[w.decode()] + 0.1) - math.log10(rest + 0.1 * (v.rest_distinct + 1))
        expected.append((-1 if i is None else i, len(words) + 1, score))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["score"]) for r in gated_lm.score_texts(docs, counts, v, flat).collect()]
    for a, b in zip(sorted(got), sorted(expected), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4, abs=1e-3)


def test_two_vocabularies_in_one_session(spark):
    """Two corpora of equal totals: a worker that is used again must not keep the vocabulary of before."""
    one = spark.createDataFrame([(i, "red blue blue") for i in range(40)], "doc_id long, text string")
    two = spark.createDataFrame([(i, "tree river river") for i in range(40)], "doc_id long, text string")
    score = lambda df: sorted((r["score"], r["base_score"]) for r in gated_lm.score_documents(df).collect())
    a, b, again = score(one), score(two), score(one)
    assert a == again and [x[1] for x in a] == pytest.approx([x[1] for x in b])


def test_learning_beats_the_base(spark):
    """Words that predict the next one: held-out documents are likelier by the network than by counts."""
    random.seed(43)
    follows = {f"w{i}": f"w{(i * 7 + 3) % 50}" for i in range(50)}

    def text():
        w, out = f"w{random.randrange(50)}", []
        for _ in range(60):
            out.append(w)
            w = follows[w] if random.random() < 0.9 else f"w{random.randrange(50)}"
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(4000)], "doc_id long, text string").repartition(2)
    r = gated_lm.score_documents(docs).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (r["s"] - r["b"]) / r["n"] > 0.15


# --- pipeline ----------------------------------------------------------------------------------------------------


def plain_mix(rows):
    """The rows as they are trained on, as a multiset: whole, once for each pass that takes them."""
    sizes, by_source = Counter(), defaultdict(list)
    for doc_id, text, source in rows:
        n = len((text or "").split())
        sizes[source] += n
        by_source[source].append((doc_id, text, n))
    targets = brute_targets(sizes, (3, 1, 2))
    digest = lambda r: hashlib.md5((("" if r[0] is None else str(r[0])) + hashlib.md5((r[1] or "").encode()).hexdigest()).encode()).hexdigest()
    out = Counter()
    for source, docs in by_source.items():
        start = 0
        for doc_id, text, n in sorted(docs, key=digest):
            for turn in range(2):
                left = math.floor(targets[source]) - (turn * sizes[source] + start)
                if left * 2 > n and n:
                    out[doc_id, text, source] += 1
            start += n
    return out


def plain_classes(rows):
    """Components of pairs of similarity 0.8 or more: of each the row of the smallest id."""
    names = [tuple(sorted(b.items())) for b in bags([t for _, t, _ in rows])]
    b, parent = bags([t for _, t, _ in rows]), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if names[i] == names[j] or similarity(b[i], b[j]) >= bagminhash.SIMILAR:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return groups


def test_pipeline_by_plain_python(spark, tmp_path):
    """Awkward rows through all five stages, each held against a plain version on what the stage before it kept."""
    random.seed(51)
    words = [f"w{i}" for i in range(400)]
    good = lambda: " ".join(random.choice(words) for _ in range(random.choice([30, 80, 200]))) + "."
    bad = lambda: " ".join(random.choice(["BUY!!", "NOW!!", "win$$$"]) for _ in range(40))
    rows = [(i, bad() if i % 4 == 0 else good(), random.choice(["a", "b", None, "hot", "hot"])) for i in range(160)]
    base = good()
    rows += [(200 + i, base.replace("w1 ", "w2 ", i % 2) + " end." * (i % 2), "a") for i in range(6)]
    rows += [(None, good(), "a"), (None, good(), None), (7, good(), "b"), (7, good(), "b"), (300, None, "a"), (301, "", None), (302, "Home | About | Us | Help\n" + good(), "a"), (303, good() + "\n" + good() + "\nshort", "hot")]
    docs = spark.createDataFrame([(*r[:2], "en", r[2], len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(160)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    shown = lambda df: Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())

    kept = written(stages["quality_classifier"](spark, docs, sf), "s1")
    model = nbsvm.train(docs, labels)
    score = lambda t: model.score(np.array([model.margin(nbsvm.indicators((t or "").encode()))]))[0]
    assert shown(kept) == Counter(r for r in rows if score(r[1]) >= 0.5)
    assert not any(r["text"] and "BUY" in r["text"] for r in kept.collect())

    cleaned = written(stages["quality_rules"](spark, kept, sf), "s2")
    expected = Counter()
    for (doc_id, text, source), n in shown(kept).items():
        figures, rest = line_rules.judge((text or "").encode())
        if figures["kept"]:
            expected[doc_id, rest.decode(), source] += n
    assert shown(cleaned) == expected and all(r["n_chars"] == len(r["text"]) for r in cleaned.collect())

    unique = written(stages["near_dedup"](spark, cleaned, sf), "s3")
    before, after = list(shown(cleaned).elements()), shown(unique)
    groups = plain_classes(before)
    assert sum(after.values()) == len(groups)
    for members in groups.values():
        here = [before[i] for i in members if before[i] in after]
        lowest = min(-1 if before[i][0] is None else before[i][0] for i in members)
        assert len({r for r in here}) == 1 and (-1 if here[0][0] is None else here[0][0]) == lowest

    mixed = written(stages["mix_sources"](spark, unique, sf), "s4")
    assert shown(mixed) == plain_mix(list(after.elements()))

    library, expected = encoding(), Counter()
    for (doc_id, text, _), n in shown(mixed).items():
        ids = library.encode_ordinary(text or "")
        expected[doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += n
    encoded = stages["byte_bpe"](spark, mixed, sf)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded.collect()) == expected
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == Counter(map(tuple, encoded.collect()))
    assert P.PATTERN and mixing.PASSES == 2
