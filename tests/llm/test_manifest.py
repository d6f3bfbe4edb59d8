"""The Merkle manifest against trees built in memory."""

import zlib
from hashlib import sha256

import pytest

import oracle
from labelloom.llm import manifest, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMA = f"{COLUMNS}, tree string, at string, key string, digest string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)])
    return levels


def way_up(levels, i):
    for nodes in levels[:-1]:
        first = i - i % 3
        yield nodes[first:i], nodes[i + 1 : first + 3]
        i //= 3


def plain_manifest(rows):
    """rows: tuples in the order of COLUMNS."""
    by_source = {}
    for row in rows:
        text, doc_id = row[1], row[0]
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        other = text.replace("\n", "") if hit and text else text
        by_source.setdefault(row[3], []).append((doc_id, leaf_of(row, text), leaf_of(row, other)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree_levels([leaf for _, leaf, _ in by_source[source]]))
    top = tree_levels([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for t, source in enumerate(order):
        for i, (doc_id, leaf, changed) in enumerate(by_source[source]):
            way = [*way_up(trees[t], i), *way_up(top, t)]
            folded = changed
            for left, right in way:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in way for x in left + right])
            out.append((doc_id, leaf, trees[t][-1][0], root, proof, folded, folded == root))
    return out


def found(docs, levels=manifest.LEVELS):
    built = manifest.build_manifest(docs, manifest.without_line_feeds(), levels)
    return [tuple(r) for r in manifest.verify(built, levels=levels).collect()]


def in_order(rows):
    return sorted(rows, key=repr)


def test_positions_are_those_of_the_log():
    for units in (1, 2, 3, 4, 9, 10, 26, 27, 28, 80):
        for levels in (manifest.levels_above(units), manifest.levels_above(units) + 2):
            leaves = [bytes([i]) * 32 for i in range(units)]
            log = manifest.append_log(leaves, levels)
            nodes, seen = leaves, []
            for level in range(levels + 1):
                for i, node in enumerate(nodes):
                    place = manifest.postorder_position(level, i, units, levels)
                    assert log[place] == node
                    seen.append(place)
                nodes = [manifest.node_digest(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
            assert sorted(seen) == list(range(len(log)))


@pytest.mark.parametrize("levels", [1, 2, manifest.LEVELS])
def test_proofs_equal_plain_trees(spark, levels):
    rows = [(i * 7 % 211, f"a\nb{i}" if i % 3 else f"c{i}", "en", ["x", "y", "", None, "é"][min(4, i % 7)], i) for i in range(211)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = found(docs, levels)
    assert in_order(got) == in_order(plain_manifest(rows))
    assert {r[-1] for r in got} == {True, False}


def test_hot_source_over_many_ranges(spark):
    rows = [(i, f"t\n{i}", "en", "hot" if i % 3 else f"s{i % 40}", 1) for i in range(3_000)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(11)
    assert in_order(found(docs, 3)) == in_order(plain_manifest(rows))


def test_log_holds_every_node_in_completion_order(spark):
    rows = [(i, f"t{i}", "en", "a" if i < 60 else None, 1) for i in range(75)]
    built = manifest.build_manifest(spark.createDataFrame(rows, COLUMNS), levels=2)
    for source, own in (("a", rows[:60]), (None, rows[60:])):
        entries = manifest.log_entries(built, levels=2).where(f"source <=> {'NULL' if source is None else repr(source)}")
        got = [r["digest"] for r in entries.orderBy("position").collect()]
        leaves = [bytes.fromhex(leaf_of(r, r[1])) for r in own]
        assert got == [d.hex() for d in manifest.append_log(leaves, manifest.levels_above(len(leaves)))]
        places = [r["position"] for r in entries.orderBy("position").collect()]
        assert places == list(range(len(got)))


def test_manifest_odd(spark):
    rows = [
        (None, None, None, None, None),
        (None, "a\nb", "en", None, 3),
        (5, "", "en", "s", 0),
        (5, "", "en", "s", 0),
        (5, "\n", "en", "s", 1),
        (-4, "é\n" * 200_000, "de", "s", 400_000),
        (2**62, "x", None, "", 1),
    ]
    docs = spark.createDataFrame([(*r, "t", "a", "k", "d") for r in rows], SCHEMA)
    assert in_order(found(docs)) == in_order(plain_manifest(rows))
    assert found(docs.limit(0)) == []
    alone = found(docs.where("doc_id = -4"))
    assert alone[0][1] == alone[0][2] == alone[0][3] and alone[0][4] == h()


def test_manifest_query_equals_plain_trees_and_sql(spark):
    df = queries.op11_manifest(spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert in_order(tuple(r) for r in df.collect()) == in_order(plain_manifest(rows))
    sql = queries.ORACLES["op11_manifest"]
    con = oracle.connect(SF)
    assert oracle.spark_rows(df) == oracle.sql_rows(con, sql)
    assert oracle.type_mismatches(df, con, sql) == []
