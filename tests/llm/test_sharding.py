"""Every shard fits, splits are the least that will do, copies are parted, odd rows have their place."""

from collections import Counter, defaultdict

from plotloom.llm import sharding as S

SCHEMA = "doc_id long, text string, h string, part int, bytes long, prefix int"


def row(i, t):
    return (i, t, "h", 1, 2, 3)


def test_least_splits_and_limits(spark):
    data = [row(i, "x" * (i * 37 % 900)) for i in range(400)] + [row(7, "copy " * 30)] * 60 + [row(None, None), row(None, ""), row(900, "y" * 5000), row(901, None)]
    limit = 4000
    docs = spark.createDataFrame(data, SCHEMA)
    got = S.sharded(docs, limit).collect()
    assert Counter((r.doc_id, r.bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t, *_ in data)
    shards, rows = defaultdict(list), defaultdict(list)
    for r in got:
        shards[r.depth, r.prefix, r.part].append(r)
    for x in shards.values():
        assert sum(r.bytes for r in x) <= limit or len(x) == 1
    hashes = S.hashed(docs).collect()
    for d in range(12):
        sums, single = Counter(), defaultdict(set)
        for r in hashes:
            sums[r.h >> 60 - d] += r.bytes
            single[r.h >> 60 - d].add(r.h)
        for p, n in sums.items():
            rows[p, d] = n <= limit or len(single[p]) == 1
    for depth, prefix, _ in shards:
        assert rows[prefix, depth] and not any(rows[prefix >> k, depth - k] for k in range(1, depth + 1))


def test_empty_table(spark):
    assert S.sharded(spark.createDataFrame([], SCHEMA)).count() == 0
