"""SimHash groups against all pairs."""
import random

import xxhash
from pyspark.sql import functions as F

from veilset.llm import simhash
from veilset.llm.components import components

from .helpers import MESSY, empty, messy, read


def brute_print(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, ids, radius=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    small = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            small[r] = min(d, small.get(r, d))
    return [small.get(find(i)) for i in range(len(ids))]


def check(got, docs):
    prints = [brute_print(t) for _, t in docs]
    groups = brute_groups(prints, [d for d, _ in docs])
    want = sorted(((d, f"{p:016x}", g) for (d, _), p, g in zip(docs, prints, groups, strict=True)),
                  key=repr)
    assert sorted(map(tuple, got), key=repr) == want


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = read(sf, "documents")
    check(simhash.cluster(spark.read.parquet(f"{sf}/documents.parquet")).collect(),
          [(d["doc_id"], d["text"]) for d in docs])


def test_spark_hash_is_the_same_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] & (2**64 - 1)
    assert got == xxhash.xxh64_intdigest("a b c", 42)


def test_messy_rows(spark):
    check(simhash.cluster(messy(spark)).collect(), [(m[0], m[1]) for m in MESSY])


def test_empty_table(spark):
    assert simhash.cluster(empty(spark)).collect() == []


def near_prints(n, seed=3):
    """Fingerprints with many links: chains of few-bit changes."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n // 20):
        x = rnd.getrandbits(64)
        for _ in range(20):
            out.append(x)
            for _ in range(rnd.choice((1, 2, 3, 4, 5))):
                x ^= 1 << rnd.randrange(64)
    return out


def test_links_connect_what_all_pairs_connect(spark):
    prints = sorted({*near_prints(600), 0, 1, 2**64 - 1})
    signed = [x - 2**64 if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_groups(prints, signed)
    # a small tree size sends shards through several slices
    for p in (simhash.Params(), simhash.Params(blocks=4, tree_size=2), simhash.Params(blocks=6)):
        labels = dict(components(simhash.links(df, p), "t").distinct().collect())
        assert [labels.get(x, x) for x in signed] == want


def test_bk_tree_finds_what_a_scan_finds():
    prints = near_prints(400, 5)
    tree = simhash.BKTree()
    for x in prints:
        tree.add(x)
    for x in prints[::17]:
        assert sorted(tree.within(x, 3)) == sorted(
            y for y in set(prints) if (x ^ y).bit_count() <= 3)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (901, 900)],
                                  "a long, b long")
    got = dict(components(edges, "chain").distinct().collect())
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_keep_one_of_each_group(spark):
    docs = messy(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = brute_groups([brute_print(m[1]) for m in MESSY], [m[0] for m in MESSY])
    want = sorted({g for m, g in zip(MESSY, groups, strict=True) if m[0] is not None})
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == want
    assert got.count(None) == sum(m[0] is None for m in MESSY)


def test_two_texts_under_one_id_are_two_documents(spark):
    """Neither is lost, whichever group the other falls into."""
    one = "the quick brown fox jumps over the lazy dog near the quiet river bank at dawn"
    two = "completely different words stand here so that no fingerprint bit agrees by design"
    docs = spark.createDataFrame([(1, one), (1, two), (2, one), (2, two), (3, two), (1, one)],
                                 "doc_id long, text string")
    got = sorted(map(tuple, simhash.keep_one(docs).collect()))
    assert got == sorted([(1, one), (1, two)])
    shifted = spark.createDataFrame([(5, one), (5, two), (4, one)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(shifted).collect())) == [(4, one), (5, two)]
