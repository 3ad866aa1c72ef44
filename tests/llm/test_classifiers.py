"""Quality, toxicity and language: held-out accuracy on made-up classes, gradients, odd inputs."""

import random

import numpy as np
import pyarrow as pa

from headroom.llm import language, learning, quality, toxicity
from headroom.llm.texts import flat


def labelled(spark, n=400, seed=1):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 8)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(draw.randrange(30, 300))]
        toxic, poor = draw.random() < 0.4, draw.random() < 0.4
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = draw.choice(["dreadful", "nitwit", "vermin"])
        if poor:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), int(not poor), int(toxic)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")


def test_toxicity_held_out(spark):
    model = toxicity.fit(labelled(spark)[1])
    rows, fresh = labelled(spark, 200, 2)
    got = {r.doc_id: r["__s"] >= 0.5 for r in toxicity.scored(fresh, model, score="__s").collect()}
    assert sum(got[i] == bool(t) for i, _, _, t in rows) >= 190
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100000), (None, "nitwit")], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, model).collect())
    assert toxicity.scored(odd.limit(0), model).count() == 0


def test_characteristic_strings_by_counting():
    toxic = [b"a nitwit came", b"the nitwit", b"nitwit nitwit", b"no word"] * 5
    toxic, ordinary = [t + b" %d" % i for i, t in enumerate(toxic)], [b"the came no word %d" % i for i in range(300)]
    found = {int(g).to_bytes(toxicity.GRAM, "big") for g in toxicity.characteristic(toxic, ordinary)}
    strings = {t[i : i + 6] for t in toxic for i in range(len(t) - 5)}
    expected = set()
    for s in strings:
        n, m = sum(s in t for t in toxic), sum(s in t for t in ordinary)
        table = np.array([n, len(toxic) - n, m, len(ordinary) - m]) + 0.5
        odds = np.log(table[0] * table[3] / table[1] / table[2])
        if odds > toxicity.ODDS and odds > toxicity.Z * np.sqrt((1 / table).sum()):
            expected.add(s)
    assert found == expected and b"nitwit" in found and b" word " not in found
    spans = toxicity._spans(toxic, toxicity.characteristic(toxic, ordinary))
    assert all(any(s in t for t in toxic) for s in spans) and any(b"nitwit" in s for s in spans)


def test_evidence_by_compressing_each_window():
    ordinary, toxic = toxicity.dictionaries([b"what a nitwit %d came by" % i for i in range(60)], [b"what a day %d came by and went" % i for i in range(300)])
    texts = [b"", b"x", b"What a NITWIT\tcame by; " * 4, b"what a day " * 30, "nitwit \u00e9".encode() * 9, b"nitwit" * 3]
    got = toxicity.evidence(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))), ordinary, toxic)
    one, two = toxicity._compressors(ordinary, toxic)
    for row, text in zip(got, texts):
        text = bytes(32 if b in b" \t\n\v\f\r" else b for b in text.lower())
        windows, at = [], 0
        while at < len(text) and (at == 0 or at + toxicity.HOP < len(text)):
            windows.append(text[at : at + toxicity.WINDOW] + toxicity.TAIL)
            at += toxicity.HOP
        saved = [len(one.compress(w)) - len(two.compress(w)) for w in windows]
        reached = np.array([sum(s >= t for s in saved) for t in toxicity.THRESHOLDS])
        assert np.allclose(row, [*np.log1p(reached), *np.log((reached + 1) / (len(windows) + toxicity.PRIOR)), np.log1p(len(windows))])
    assert got[2][0] > 0 and got[0][0] == got[3][4] == 0


def test_toxicity_passes_other_columns_and_scores_copies_alike(spark):
    model = toxicity.fit(labelled(spark)[1])
    rows = [(1, "a dreadful nitwit and vermin", 5, "x"), (1, "a dreadful nitwit and vermin", 6, None), (2, None, 7, "y"), (3, "dreadful " * 200000, 8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, toxic string")
    got = sorted(toxicity.scored(docs, model, score="__s").collect(), key=lambda r: r.label)
    assert [tuple(r)[:4] for r in got] == rows and got[0]["__s"] == got[1]["__s"] and got[3]["__s"] > 0.5


def test_quality_held_out(spark):
    model = quality.fit(labelled(spark)[1], epochs=4)
    rows, fresh = labelled(spark, 200, 2)
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(fresh, model).collect()}
    assert sum(got[i] == bool(q) for i, _, q, _ in rows) >= 190
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 1200000)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, model).collect())


def test_quality_gradients():
    draw = np.random.default_rng(4)
    network = quality.Network(3)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    sizes = [0, 40, 700, 300]
    data = draw.integers(32, 120, sum(sizes)).astype(np.uint8)
    offsets, y = np.concatenate(([0], np.cumsum(sizes))), np.array([1, 0, 1, 0.0])

    def loss():
        p = np.clip(network.score(data, offsets), 1e-12, 1 - 1e-12)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = network.gradients(data, offsets, y)
    for name, value in network.p.items():
        spots = np.argsort(-np.abs(g[name]).ravel())[:3]
        for k in spots:
            old = value.flat[k]
            value.flat[k] = old + 1e-6
            up = loss()
            value.flat[k] = old - 1e-6
            down = loss()
            value.flat[k] = old
            assert abs((up - down) / 2e-6 - g[name].flat[k]) < 1e-4 + 0.01 * abs(g[name].flat[k]), name


def test_no_labels(spark):
    empty = spark.createDataFrame([], "text string, toxic int, quality int")
    one = spark.createDataFrame([("a", 1, 1), ("b", None, None)], "text string, toxic int, quality int")
    text = flat(pa.array(["a", None]))
    assert toxicity.fit(empty).score(*text).tolist() == [0, 0] and quality.fit(empty).score(*text).tolist() == [0, 0]
    assert toxicity.fit(one).score(*text).tolist() == [1, 1] and quality.fit(one).score(*text).tolist() == [1, 1]


def brute_kneser_ney(texts, order, discount):
    """Interpolated Kneser-Ney by its definition, from padded strings."""
    lines = [" " * (order - 1) + t for t in texts]
    counts = {}
    for t in lines:
        for i in range(order - 1, len(t)):
            counts[t[i - order + 1 : i + 1]] = counts.get(t[i - order + 1 : i + 1], 0) + 1
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        below = {}
        for gram in tables[n + 1] if n == order - 1 else {g[order - n - 1 :] for g in counts}:
            below.setdefault(gram[1:], set()).add(gram[0])
        tables[n] = {g: len(s) for g, s in below.items()}
    alphabet = len({g[-1] for g in counts}) + 1

    def p(gram):
        if not gram:
            return 1 / alphabet
        table = tables[len(gram)]
        row = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        if not row:
            return p(gram[1:])
        total = sum(row.values())
        return max(row.get(gram, 0) - discount, 0) / total + discount * len(row) / total * p(gram[1:])

    return p


def test_kneser_ney_by_definition():
    texts = ["banana bandana", "a nab", "cabana"]
    model = language.Model(texts, np.array(["x"] * 3))
    p = brute_kneser_ney(texts, language.ORDER, language.DISCOUNT)
    lines = [" " * 3 + "b", "  ba", "anan", "nana", "dana", "zzzz", "an z", "xban", "n ba"]
    got = model.log_probability(np.array([[ord(c) for c in line] for line in lines], np.uint32))[:, 0]
    assert np.allclose(np.exp(got), [p(line) for line in lines])
    bits, size = model.entropies(*flat(pa.array(["Banana!  zab", "", None, "a"])))
    text = "banana zab"
    want = -sum(np.log(p(("   " + text)[i : i + 4])) for i in range(len(text))) / len(text)
    assert size.tolist() == [10, 0, 0, 1] and np.isclose(bits[0, 0], want, atol=1e-5) and np.isclose(bits[3, 0], -np.log(p("   a")), atol=1e-5)


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in language.op4_kneser_ney_language(spark, sf).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows) and sum(got[r.doc_id].lang_pred == r.lang for r in rows) > 0.93 * len(rows)
    model = language.fit(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 $$ 9"), (4, "der und die " * 20000), (None, "qqqq zzzz xxxx " * 9)], "doc_id long, text string")
    out = {r.doc_id: r for r in language.identified(odd, model).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "und", "de"] and out[3].score == 0 and out[None].rejected and not out[4].rejected
    assert language.identified(odd, language.Model([], np.array([]))).filter("lang_pred = 'und'").count() == 5


def test_sample_with_a_large_group_of_copies(spark):
    from collections import Counter

    from headroom.llm.learning import class_sample

    seen = []
    for tag in range(4):  # whatever the hash of the copied text
        rows = [(f"copy {tag}", 1)] * 3000 + [(f"toxic {tag} {i}", 1) for i in range(1000)] + [(f"plain {tag}", 0)] * 2500 + [(None, 2)] * 3
        texts, labels, counts = class_sample(spark.createDataFrame(rows, "text string, label int"), "text", "label", 200, 4096)
        assert counts == {0: 2500, 1: 4000, 2: 3} and len(texts) == len(labels)
        by = {k: Counter(t for t, x in zip(texts, labels) if x == k) for k in counts}
        assert by[0] == {f"plain {tag}": 200} and by[2] == {"": 3} and sum(by[1].values()) == 200
        seen.append(by[1][f"copy {tag}"])
        assert len(by[1]) > 30  # not mostly one text beyond its share
    assert all(abs(x - 150) <= 12 for x in seen)  # the others are weighed by a draw of 199 of 1000: 150, deviation 2.4
    model = toxicity.fit(spark.createDataFrame([("calm words", 0)] * 30 + [("nitwit vermin", 1)] * 9, "text string, toxic int"), per_class=5)
    assert np.isfinite(model.bias) and model.score(*flat(pa.array(["calm words"])))[0] < 1


def test_all_labels_are_sampled(spark):
    from headroom.llm.learning import class_sample

    rows = [(f"t{i}", f"l{i}") for i in range(1200)]
    assert len(class_sample(spark.createDataFrame(rows, "text string, label string"), "text", "label", 3, 4096)[2]) == 1200


def test_sample_by_a_table_of_labels_equals_labelled_rows(spark, table):
    """The table of labels meets hashes only, yet the same rows are drawn."""
    docs = table([(i, f"text number {i % 40}") for i in range(120)] + [(200, None), (201, "unlabelled")])
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(120)] + [(200, 1), (7, 1), (999, 0), (3, None)], "doc_id long, quality int")
    joined = docs.join(labels, "doc_id").select("text", "quality")
    for size in (10, 1000):
        texts, own, counts = learning.class_sample(joined, "text", "quality", size, 4096)
        again = learning.class_sample(docs, "text", "quality", size, 4096, labels, "doc_id")
        assert (again[0], again[1].tolist(), again[2]) == (texts, own.tolist(), counts)
