import random
from collections import Counter, defaultdict

from tianguis.llm import near_dedup
from tianguis.llm.components import connected_components
from tianguis.llm.near_dedup import Forest, forest_depth, forest_levels, most_disagreements, near_duplicates, shingle_set
from tianguis.llm.staging import staged
from tianguis.llm.queries import op4_ngram_jaccard_join


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def components(edges, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute_force(rows):
    """{doc_id: (copy_id, class_id, n_links)} over different ids."""
    sets = {i: shingles(t) for i, t in rows}
    copies = {}
    for i, s in sets.items():
        copies[s] = min(i, copies.get(s, i))
    listed = [s for s in copies if s]
    links = [(a, b) for k, a in enumerate(listed) for b in listed[k + 1 :] if len(a & b) >= 0.8 * len(a | b)]
    classes = components([(copies[a], copies[b]) for a, b in links], list(copies.values()))
    return {i: (copies[s], classes[copies[s]], sum(s in pair for pair in links)) for i, s in sets.items()}


def found(df):
    return {r.doc_id: (r.copy_id, r.class_id, r.n_links) for r in df.collect()}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(90)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == components(edges, nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_depth_is_shortened_until_the_target():
    assert forest_depth(0.8, 40, 0.99999) == 6
    assert forest_depth(0.8, 40, 0.9) > 6
    assert forest_depth(0.1, 2, 0.999) == 1
    assert forest_levels(0.8, 40, 0.99999) == [8, 6]


def near_copies(rng, n, groups):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([8, 60, 300]))]
        for _ in range(n):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


def forest_rows(texts):
    levels = forest_levels(0.8, 40, 0.99999)
    forest = Forest(40, levels)
    return [forest.signature(shingle_set(t)) for t in texts], most_disagreements(40 * levels[0], 0.8)


def buckets(signatures, at):
    found = defaultdict(list)
    for i, (paths, _) in enumerate(signatures):
        for path in paths[at * 40 : at * 40 + 40]:
            found[int(path)].append(i)
    return [b for b in found.values() if len(b) > 1]


def test_longer_prefixes_refine_shorter_ones():
    signatures, _ = forest_rows([t for _, t in near_copies(random.Random(3), 8, 4)])
    longer, shorter = buckets(signatures, 0), buckets(signatures, 1)
    assert longer and all(any(set(b) <= set(c) for c in shorter) for b in longer)


def test_pairs_at_the_threshold_agree_in_their_sketches():
    rng, pairs = random.Random(5), 0
    for size in (20, 45, 200):
        for _ in range(60):
            shared, own = round(size * 0.8), size - round(size * 0.8)
            words = [[f"s{rng.random()}"] for _ in range(shared)]
            sides = [words + [[f"o{rng.random()}"] for _ in range(own // 2)] for _ in range(2)]
            # Sets of single words, so the similarity is known: at least 0.8.
            most, forest = most_disagreements(320, 0.8), Forest(40, [8, 6])
            sketches = [forest.signature(shingle_set(" ".join(w[0] for w in s), 1))[1] for s in sides]
            assert near_dedup._sketch_edges([(0, 0, 0, sketches[0]), (1, 0, 1, sketches[1])], False, most) == [(0, 1)]
            pairs += 1
    assert pairs == 180


def test_texts_that_share_a_template_are_not_joined(documents):
    rng = random.Random(6)
    shared = " ".join(f"t{k}" for k in range(300))
    texts = [shared + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(300)]
    signatures, most = forest_rows(texts)
    met = buckets(signatures, 1)
    assert met  # prefixes alone would join them
    for bucket in met:
        assert near_dedup._sketch_edges([(i, 0, i, signatures[i][1]) for i in bucket], False, most) == []
    assert {r.n_links for r in near_duplicates(documents(list(enumerate(texts)))).collect()} == {0}


def test_a_bucket_is_joined_by_few_edges():
    (signature,), most = forest_rows(["one two three four five six seven"])
    rows = [(i, i % 2, i, signature[1]) for i in range(50)]
    assert near_dedup._sketch_edges(rows, False, most) == [(0, i) for i in range(1, 50)]
    across = near_dedup._sketch_edges(rows, True, most)
    assert len(across) == 49 and all((a - b) % 2 for a, b in across)


def test_hot_nodes_are_split_by_the_join(spark, documents):
    """A join with a staged minimum has an exchange of its own on both sides, which the skew join needs."""
    rng = random.Random(9)
    rows = [(i, f"{'same words again and again ' * 3}{i}" if i % 3 else " ".join(f"w{rng.random()}" for _ in range(9))) for i in range(3000)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        edges = spark.createDataFrame([(0, i) for i in range(1, 4000)] + [(i, i + 1) for i in range(5000, 9000, 2)], "a long, b long")
        edges = staged(edges.repartition(8), "edges")
        least = staged(edges.groupBy("a").agg({"b": "min"}).toDF("a", "m"), "least")
        joined = edges.join(least, "a")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert found(near_duplicates(documents(rows[:60]))) == brute_force(rows[:60])
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_links_match_brute_force(documents):
    rows = near_copies(random.Random(7), 25, 12)
    rows += [(1000 + i, t) for i, t in enumerate(["", None, " \n", "one two", "one  two", "x y z", "long " * 50, "long " * 51])]
    want = brute_force(rows)
    assert sum(n for *_, n in want.values()) > 100
    assert found(near_duplicates(documents(rows))) == want
    # Blocks so small that every component is cut give the same links.
    assert found(near_duplicates(documents(rows), block_documents=4)) == want


def test_one_row_of_each_class_is_kept(documents):
    rows = near_copies(random.Random(8), 10, 5)
    rows += [(3, rows[3][1]), (None, rows[20][1]), (900, None), (900, None)]
    out = near_duplicates(documents(rows), carry=True).collect()
    assert len(out) == len(rows)
    kept = [r for r in out if r.kept]
    assert len(kept) == len({r.class_id for r in out}) and all(r.doc_id == r.class_id for r in kept)
    assert Counter((r.row.doc_id, r.row.text) for r in out) == Counter(rows)


def test_empty_table_and_clashing_names(spark, documents):
    assert near_duplicates(documents([])).collect() == []
    df = spark.createDataFrame([(1, "a b", 2, 3)], "doc_id long, text string, place int, component int")
    assert near_duplicates(df, carry=True).select("row.*").columns == df.columns


def test_query_finds_all_links_of_a_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(op4_ngram_jaccard_join(spark, sf_dir)) == brute_force(rows)


def test_paths_move_only_to_the_join_that_finds_who_meets(documents, monkeypatch):
    """What is staged besides the signatures has no paths but of members that meet another one; copies are one of them."""
    rng, tables = random.Random(10), {}
    written = near_dedup.staged

    def recorded(df, name):
        tables.setdefault(name, []).append(out := written(df, name))
        return out

    monkeypatch.setattr(near_dedup, "staged", recorded)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    alone, base = [" ".join(text(80)) for _ in range(60)], text(200)
    texts = alone + alone[:20] + [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(["y", *base[1:]])] + [" ".join(base)] * 30
    rows = list(enumerate(texts))
    want = brute_force(rows)
    assert found(near_duplicates(documents(rows))) == want
    members = [r.member for t in tables["met"] for r in t.collect()]
    assert len(set(members)) == 3 and len(members) <= 3 * near_dedup.TREES
    assert [name for name, made in tables.items() if any("paths" in t.columns for t in made)] == ["shingles"]
