"""Context-tree weighting against the recursive definition, word counts against plain Python."""

import math
import re
from collections import Counter
from pathlib import Path
from urllib.parse import unquote, urlparse
from zlib import crc32

import numpy as np
import pytest

from headroom.llm import treeweighting as c
from headroom.llm.texts import flat

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    return SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sequence(text):
    return bytes(c.DEPTH) + b" ".join(w.encode() for w in plain(text)) + bytes([c.END])


def brute_weights(texts):
    """Counts per (decision point, context), and the weighted log probability by recursion."""
    counts = Counter()
    for text in texts:
        s = sequence(text)
        for i in range(c.DEPTH, len(s)):
            for bit in range(8):
                prefix = (1 << bit) | (s[i] >> (8 - bit))
                for d in range(c.DEPTH + 1):
                    counts[prefix, s[i - d : i], (s[i] >> (7 - bit)) & 1] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    children = {}
    for prefix, context, _ in counts:
        if context:
            children.setdefault((prefix, context[1:]), set()).add(context)
    own, mixed = {}, {}

    def weigh(prefix, context):
        if (prefix, context) not in mixed:
            own[prefix, context] = kt(counts[prefix, context, 0], counts[prefix, context, 1])
            if len(context) == c.DEPTH:
                mixed[prefix, context] = own[prefix, context]
            else:
                below = sum(weigh(prefix, x) for x in children[prefix, context])
                mixed[prefix, context] = np.logaddexp(math.log(0.5) + own[prefix, context], math.log(0.5) + below)
        return mixed[prefix, context]

    for prefix in {p for p, _, _ in counts}:
        weigh(prefix, b"")
    return counts, own, mixed


def brute_score(text, counts, own, mixed):
    s, total = sequence(text), 0.0
    for i in range(c.DEPTH, len(s)):
        for bit in range(8):
            prefix = (1 << bit) | (s[i] >> (8 - bit))
            known = [d for d in range(c.DEPTH + 1) if (prefix, s[i - d : i]) in own]
            one = [(counts[prefix, s[i - d : i], 1] + 0.5) / (counts[prefix, s[i - d : i], 0] + counts[prefix, s[i - d : i], 1] + 1) for d in known]
            p = one[-1] if known else 0.5
            for d in known[:-1][::-1]:
                w = math.exp(math.log(0.5) + own[prefix, s[i - d : i]] - mixed[prefix, s[i - d : i]])
                p = w * one[d] + (1 - w) * p
            total += math.log10(p if (s[i] >> (7 - bit)) & 1 else 1 - p)
    return total


def base(rows):
    learn = [plain(t) for i, t in rows if crc32(("" if i is None else str(i)).encode()) % 10]
    count = Counter(w for ws in learn for w in ws)
    count["\n"] = len(learn)
    count = +count
    total, kinds = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        ws = plain(t) + ["\n"]
        value = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws) if total + kinds + 1 else 0
        out.append((i, crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(ws), sum(count[w] > 0 for w in ws), total, value))
    return out


def check(rows, got):
    texts = [t for i, t in rows if crc32(("" if i is None else str(i)).encode()) % 10]
    state = brute_weights(texts)
    want = sorted(zip(base(rows), [brute_score(t, *state) for _, t in rows]), key=repr)
    have = sorted((((r.doc, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score), r.score) for r in got), key=repr)
    assert len(want) == len(have)
    for (a, s), (b, t) in zip(want, have):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9) and s == pytest.approx(t, rel=2e-6, abs=1e-5)


def test_brute_force(table):
    text = "The cat  sat on the mat. ÉTÉ été\tthe\n\nCat the dog"
    rows = [(i, " ".join(text.split()[i % 5 :][: 3 + i % 7]) + "\t" * (i % 3)) for i in range(60)] + [(None, "the cat"), (70, ""), (71, None), (72, " \n "), (73, "zebra zz the"), (73, "zebra zz the"), (80, " x")]
    got = c.scored(table(rows).selectExpr("*", "1 as row", "2 as doc", "3 as key"), c.share_of("doc_id", 10) == 0).collect()
    check(rows, got)


def test_without_learning_rows(spark, table):
    from pyspark.sql import functions as F

    got = c.scored(table([(1, "ab"), (2, None)]), F.lit(True)).orderBy("doc").collect()
    assert got[0].score == pytest.approx(3 * 8 * math.log10(0.5)) and got[0].train_tokens == 0 and got[0].n_known == 0
    assert c.scored(table([]), F.lit(True)).count() == 0


def test_cut_tree_stays_a_distribution():
    import pyarrow as pa

    codes, _ = c.coded(*flat(pa.array(["abracadabra banana", "abab cabana"] * 9)))
    keys = [np.unique(codes & m, return_counts=True) for m in c.CODE_MASKS]
    kept = [(k, n) if d < 3 else (k[n > 9], n[n > 9]) for d, (k, n) in enumerate(keys)]
    tree = c.Tree(kept)
    for context in np.unique(codes >> np.uint64(8))[:20]:
        all_bytes = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** tree.log10_probability(all_bytes)).sum() - 1) < 1e-9
        whole = tree.score(all_bytes, np.arange(257))
        assert np.allclose(whole, tree.log10_probability(all_bytes), atol=1e-5)


def test_codes_of_a_text_are_its_own():
    import pyarrow as pa

    codes, offsets = c.coded(*flat(pa.array([" Ab  c ", "", None, "b"])))
    assert offsets.tolist() == [0, 5, 6, 7, 9]
    assert bytes(int(x) & 255 for x in codes) == b"ab c\n\n\nb\n" and int(codes[7]) == ord("b")


def test_no_context_is_cut_whatever_the_size(table, monkeypatch):
    """Over 262,144 coded bytes a context seen once still has its own estimate, in several parts and with strings joined by a shuffle."""
    import pyarrow as pa

    draw = np.random.default_rng(7)
    pool = ["".join(draw.choice(list("abcdefghij"), 5)) for _ in range(3000)]
    rows = [(i, " ".join(draw.choice(pool, 900))) for i in range(60)] + [(1000, "Qqx zyx"), (1001, "qqx zyx qqx")]
    monkeypatch.setattr(c, "CODE_SHARE", 2.0**-10)
    got = {r.doc: r.score for r in c.scored(table(rows), c.share_of("doc_id", 10) == 0, codes=5000).collect()}
    learn = [t for i, t in rows if crc32(str(i).encode()) % 10]
    codes, _ = c.coded(*flat(pa.array(learn)))
    assert len(codes) > 262_144 + 5000
    whole = c.Tree([np.unique(codes & m, return_counts=True) for m in c.CODE_MASKS])
    for i, t in rows:
        code, _ = c.coded(*flat(pa.array([t])))
        assert got[i] == pytest.approx(whole.log10_probability(code).sum(), rel=1e-5)


def test_parts_of_the_tree_agree_with_brute_force(table):
    text = "The cat  sat on the mat. the\n\nCat the dog and a cab"
    rows = [(i, " ".join(text.split()[i % 5 :][: 3 + i % 7])) for i in range(60)] + [(None, "the cat"), (73, "zebra zz the")]
    check(rows, c.scored(table(rows), c.share_of("doc_id", 10) == 0, codes=9).collect())


def test_what_is_stored_grows_with_strings_not_with_places(table, monkeypatch):
    """eight bytes for every place whose string isn't frequent, and two tables of all strings, took over four times the input."""
    draw = np.random.default_rng(11)
    pool = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), draw.integers(2, 11))) for _ in range(4000)]
    rows = [(i, " ".join(pool[int(4000 * x**3)] for x in draw.random(2500))) for i in range(200)]
    sizes = {}

    def stored(df, label="table", **options):
        out = before(df, label, **options)
        sizes[label] = sum(Path(unquote(urlparse(f).path)).stat().st_size for f in out.inputFiles())
        return out

    before = c.stored
    monkeypatch.setattr(c, "stored", stored)
    monkeypatch.setattr(c, "CODE_SHARE", 2.0**-10)
    assert c.scored(table(rows), c.share_of("doc_id", 10) == 0).count() == 200
    assert sum(sizes.values()) < 1.5 * sum(len(t) for _, t in rows), sizes


def test_answers_of_many_blocks_and_rows_agree_with_brute_force(table, monkeypatch):
    """Blocks of a few texts, strings sorted a few at a time, and a block that tells its strings in several rows."""
    text = "The cat  sat on the mat. \n\nCat the dog and a cab"
    rows = [(i, " ".join(text.split()[i % 5 :][: 3 + i % 7])) for i in range(60)] + [(None, "the cat"), (73, "zebra zz the"), (74, None)]
    monkeypatch.setattr(c, "BLOCK", 200)
    monkeypatch.setattr(c, "COUNTED", 50)
    monkeypatch.setattr(c, "MANY", 8)
    monkeypatch.setattr(c._asked, "__defaults__", (40,))
    check(rows, c.scored(table(rows), c.share_of("doc_id", 10) == 0, codes=50).collect())


def test_pieces_of_a_block_stay_large():
    """Blocks times parts would grow with the square of the input."""
    names = 1_000_000  # of a block
    for blocks in (10, 512, 2000, 8000):
        size = c._part_size(c.CODES, blocks)
        assert c.CODES <= size <= c.MOST * c.CODES and names / -(-blocks * names // size) > 500
