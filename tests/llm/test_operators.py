"""The corpus operators against plain Python, on small tables with every odd case."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm import chat, decontamination, jaccard, packing, recipes, repeats, sanitise, token_files, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "label", "n_words", "whole", "__score", "__hits", "text_sha256", "kept", "part", "shingles", "capture", "chunk", "bucket")


def prose(rng, n, words=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Unrelated, equal, nearly equal, overlapping, empty, null, one-word and very long texts."""
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    passage = " ".join(f"shared{k}" for k in range(60))
    out = base + base[:6] + [None, "", "", " \t\n", "one", "One", "two words", "İstanbul ß É　é x\x0by\x1cz", passage]
    out += [f"{t} {passage}\n{u}" for t, u in zip(base[6:12], base[12:18])]
    for t in base[18:26]:
        w = t.split()
        for k in rng.sample(range(len(w)), max(1, len(w) // 40)):
            w[k] = "changed"
        out.append(" ".join(w))
    out += ["z" * 30000, prose(rng, 9000), (prose(rng, 30) + "\n") * 40]
    return [(i, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", None) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Nulls in every column, repeated rows, and columns named like those that the operators use."""
    more = spark.createDataFrame([(None, None, None, None, None), (None, "a null id", None, None, 1), (3, "another text of id 3", None, "s1", 2)], SCHEMA)
    some = docs.filter("doc_id < 5")
    out = docs.union(more).union(some).union(some)
    return out.withColumns({c: F.lit(None).cast("string") for c in CLASHING if c != "whole"}).withColumn("whole", F.lit(1))


def plain(df, *columns):
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


# -- repeats ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_repeats_match_brute_force(docs, texts, limit):
    got = repeats.remove_repeats(docs, group_suffixes=limit)
    assert plain(got.withColumn("sha", F.sha2("kept_text", 256)), "doc_id", "n_words", "n_removed", "sha") == sorted(brute.without_repeats(texts))
    for r in got.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r.removed) == r.n_removed


def test_repeats_of_odd_rows(odd, empty):
    assert repeats.remove_repeats(odd).count() == odd.count()
    assert repeats.remove_repeats(empty).count() == 0


def test_a_null_id_is_the_largest_and_an_id_does_not_repeat_itself(spark):
    text = " ".join(map(str, range(20)))
    got = repeats.remove_repeats(spark.createDataFrame([(None, text), (7, text), (7, text), (-(2**62), text + " x")], "doc_id long, text string"))
    assert plain(got, "doc_id", "n_removed") == [(None, 20), (-(2**62), 0), (7, 20), (7, 20)]


# -- exact copies -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [(512, 4096), (2, 7)])
def test_recipes_match_brute_force(docs, texts, sizes):
    groups = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    want = sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), brute.sha(t or "")) for i, t in texts)
    assert plain(recipes.copies(docs, least=sizes[0], most=sizes[1]), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_chunks_cover_the_text(spark, docs, texts):
    got = docs.select("doc_id", F.concat_ws("", recipes.chunks(F.coalesce("text", F.lit("")), 5, 20)).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {i: t or "" for i, t in texts}


def test_chunks_that_share_a_key_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(recipes.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    got = recipes.copies(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string"))
    assert plain(got, "doc_id", "keep_id") == [(1, 3), (2, 2), (3, 3)]


def test_dropped_copies_keep_their_columns(odd, empty):
    got = recipes.drop_copies(odd)
    assert got.columns == odd.columns
    assert got.count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert recipes.drop_copies(empty).count() == recipes.copies(empty).count() == 0


# -- near copies ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("length,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("block", [2_000_000, 120])
def test_links_match_brute_force(docs, texts, length, percent, block, monkeypatch):
    monkeypatch.setattr(brute, "shingles", lambda t, n=3, own=brute.shingles: own(t, length))
    got = jaccard.near_duplicates(docs, length=length, percent=percent, block_shingles=block)
    assert plain(got, "doc_id", "n_shingles", "component_id") == brute.components(texts, percent)


def test_chains_of_links_over_many_blocks(spark):
    """Each text links with the next alone, so a component is held together by its members only."""
    rows = [(k, " ".join(f"v{j}" for j in range(k * 2, k * 2 + 80))) for k in range(60)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=300)
    assert plain(got, "doc_id", "n_shingles", "component_id") == brute.components(rows) and {r.component_id for r in got.collect()} == {0}


def test_near_copies_of_odd_rows(odd, empty):
    got = jaccard.near_duplicates(odd)
    assert got.count() == odd.count() and got.filter("doc_id IS NULL AND component_id IS NOT NULL").isEmpty()
    kept = jaccard.keep_first(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id IS NULL").count() == 2
    assert jaccard.near_duplicates(empty).count() == jaccard.keep_first(empty).count() == 0


def test_unrelated_large_sets_share_no_group_and_linked_sets_of_any_size_do():
    import numpy as np

    rng, bands = np.random.default_rng(5), jaccard.Bands(90)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    keyed = lambda sets: jaccard.group_keys(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), bands)
    keys, texts = keyed([draw(2400) for _ in range(200)])
    assert len(np.unique(keys)) == len(keys) and len(np.unique(texts)) == 200
    sizes = [*range(1, 80), *rng.integers(80, 4000, 60).tolist()]
    for n in sizes:
        x = draw(n)
        differ = n * 10 // 190  # swapped for others, the pair still links
        cut = n - -(-n * 90 // 100)  # left out, it does as well
        for y in (np.sort(np.concatenate([x[differ:], draw(differ)])), x[cut:]):
            keys, texts = keyed([x, y])
            assert set(keys[texts == 0].tolist()) & set(keys[texts == 1].tolist())


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_sizes_of_linked_sets_are_in_adjacent_steps(spark, percent):
    sizes = spark.range(1, 20000).select(F.col("id").alias("n"), F.ceil(F.col("id") * percent / 100).alias("least"))
    steps = sizes.select((jaccard._size_step(F.col("n"), percent) - jaccard._size_step(F.col("least"), percent)).alias("d"))
    assert {r.d for r in steps.distinct().collect()} <= {0, 1}


def test_linked_sets_share_a_rare_key_and_a_common_passage_is_none():
    import numpy as np

    rng = np.random.default_rng(7)
    passage = rng.integers(1 << 63, size=40, dtype=np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(1 << 63, size=60, dtype=np.uint64)])) for _ in range(30)]
    sets += [np.unique(np.concatenate([s[rng.random(len(s)) > rng.uniform(0, 0.2)], rng.integers(1 << 63, size=int(rng.integers(12)), dtype=np.uint64)])) for s in sets]
    values, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    counts = np.bincount(jaccard._cells(values), minlength=jaccard.CELLS).astype(np.uint16)
    keys, texts = jaccard.rarest_keys(values, bounds, 80, counts)
    own = [set(keys[texts == i].tolist()) for i in range(len(sets))]
    plainly = [set(s.tolist()) for s in sets]
    alike = [(i, j) for i in range(60) for j in range(i) if 5 * len(plainly[i] & plainly[j]) >= 4 * len(plainly[i] | plainly[j])]
    assert alike and all(own[i] & own[j] for i, j in alike)
    assert not any(own[i] & own[j] for i in range(30) for j in range(i))


# -- decontamination ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def items(texts):
    by = dict(texts)
    words = [by[k].split() for k in (20, 21, 22, 23, 24)]
    return [(1, " ".join(words[0][3:30])), (2, "w1 W2 w1"), (3, None), (4, ""), (5, "one"), (10, " ".join(words[1])), (10, by[57]), (None, "two words"), (11, "İstanbul")]


@pytest.mark.parametrize("shard", [200_000, 30])
def test_contamination_matches_brute_force(spark, docs, texts, items, shard):
    got = decontamination.judge(docs, spark.createDataFrame(items, "item_id long, text string"), shard_words=shard)
    got = got.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"), "contaminated")
    named = [("" if i is None else i, t) for i, t in items]
    assert plain(got, *got.columns) == sorted(brute.contamination(texts, named))


def test_automaton_finds_every_window():
    rng = random.Random(5)
    for _ in range(30):
        tests = [(str(k), [rng.randrange(3) for _ in range(rng.randint(1, 30))]) for k in range(4)]
        stream = [rng.randrange(3) for _ in range(60)]
        got = {(a, b, n) for a, b, names in decontamination.Automaton(tests, 5).matches(stream) for n in names}
        want = set()
        for name, own in tests:
            size = min(5, len(own))
            for f in range(len(own) - size + 1):
                want |= {(k, k + size - 1, name) for k in range(61 - size) if stream[k : k + size] == own[f : f + size]}
        assert got == want


def test_contaminated_documents_go_and_others_stay(spark, odd, empty, items):
    tests = spark.createDataFrame(items, "item_id long, text string")
    bad = {r.doc_id for r in decontamination.judge(odd, tests).filter("contaminated").collect()}
    got = decontamination.drop_contaminated(odd, tests)
    assert got.columns == odd.columns and bad and got.exceptAll(odd).isEmpty()
    assert got.count() == odd.count() - decontamination.judge(odd, tests).filter("contaminated").count()
    assert decontamination.drop_contaminated(odd, tests.limit(0)).count() == odd.count()
    assert decontamination.drop_contaminated(empty, tests).count() == decontamination.judge(empty, tests).count() == 0


def test_spans_are_cut_out(spark):
    test = " ".join(f"q{k}" for k in range(15))
    rows = [(1, f"Before, {test} after. " + "word " * 40), (2, "Clean, as it was."), (3, test)]
    got = decontamination.remove_spans(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, test)], "item_id long, text string"))
    assert plain(got, "doc_id", "text") == [(1, "before after " + " ".join(["word"] * 40)), (2, "Clean, as it was.")]


# -- packing ----------------------------------------------------------------------------------------------------------------


def test_bins_hold_every_word_once_and_no_conflict(docs, texts):
    rows = packing.pack(docs, packing.word_count(F.col("text")), source=F.col("source"), cluster=F.xxhash64("text"), capacity=50, shard_pieces=30).collect()
    bins, covered = {}, {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
        covered.setdefault(r.doc_id, []).append((r.first_word, r.n_words))
    for own in bins.values():
        assert sum(r.n_words for r in own) <= 50 and sorted(r.position for r in own) == list(range(len(own)))
        assert len({r.source for r in own}) == len(own) == len({r.cluster for r in own})
    for i, t in texts:
        n, at = len(brute.words(t)), 0
        for first, size in sorted(covered.get(i, [])):
            assert first == at and size > 0
            at += size
        assert at == n
    assert len({r.shard for r in rows}) > 1


def test_the_tightest_compatible_bin_is_found():
    rng = random.Random(1)
    bins, plainly = packing.Bins(100), []
    for size in sorted((rng.randint(1, 100) for _ in range(400)), reverse=True):
        source, cluster = 1 << rng.randrange(6), rng.choice([0, 1 << rng.randrange(20)])
        fits = [b for b in plainly if b[0] >= size and not (b[1] & source or b[2] & cluster)]
        best = min((b[0] for b in fits), default=None)
        before = {b: r for r, own in bins.at.items() for b in own}
        b = bins.place(size, source, cluster)
        assert before.get(b) == best
        if best is None:
            plainly.append([100 - size, source, cluster])
        else:
            plainly[b] = [best - size, plainly[b][1] | source, plainly[b][2] | cluster]


def test_packing_of_odd_rows(odd, empty):
    assert packing.packed_documents(odd).filter("doc_id IS NULL").count() == 1
    assert packing.packed_documents(empty).count() == 0


def plain_bins(pieces, capacity):
    """Best fit in plain Python over (doc_id, piece, words, source, cluster): sets of (doc_id, piece)."""
    bins = []  # [room, when it last changed, sources, clusters, members]
    for when, (i, k, n, source, cluster) in enumerate(sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1]))):
        fits = [b for b in bins if b[0] >= n and not (source is not None and source in b[2]) and not (cluster is not None and cluster in b[3])]
        b = min(fits, key=lambda b: (b[0], b[1]), default=None)
        if b is None:
            b = [capacity, 0, set(), set(), set()]
            bins.append(b)
        b[0], b[1] = b[0] - n, when
        b[2].add(source), b[3].add(cluster), b[4].add((i, k))
    return sorted(sorted(b[4]) for b in bins)


def test_bins_equal_a_plain_best_fit(docs, texts):
    capacity = 60
    rows = packing.pack(docs, packing.word_count(F.col("text")), source=F.col("source"), cluster=F.xxhash64("text"), capacity=capacity).collect()
    pieces = [(i, k, min(capacity, n - k * capacity), f"s{i % 3}", t) for i, t in texts for n in [len(brute.words(t))] for k in range(-(-n // capacity))]
    found = {}
    for r in rows:
        found.setdefault((r.shard, r.bin), []).append((r.doc_id, r.piece))
    assert sorted(sorted(b) for b in found.values()) == plain_bins(pieces, capacity)


@pytest.mark.parametrize("kind", ["null ids", "one id", "long documents"])
def test_pieces_of_one_name_are_spread_over_shards(spark, kind):
    n, size = {"null ids": (20_000, 30), "one id": (20_000, 30), "long documents": (100, 15_000)}[kind]
    docs = spark.range(n).select(F.when(F.lit(kind == "long documents"), F.col("id")).when(F.lit(kind == "one id"), F.lit(7)).alias("doc_id"), F.lit(size).cast("long").alias("n"))
    rows = packing.pack(docs, F.col("n"), capacity=50, shard_pieces=1000)
    largest = rows.groupBy("shard").count().agg(F.max("count")).first()[0]
    assert largest < 2000 and rows.agg(F.sum("n_words")).first()[0] == n * size
    assert rows.groupBy("shard", "bin").agg(F.sum("n_words").alias("n")).filter("n > 50").isEmpty()


def test_loose_bins_are_packed_again_over_all_shards(spark):
    """Many shards give about as many bins as one: what each of them leaves half empty is put together."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).cast("long").alias("n"), (F.col("id") % 700).cast("string").alias("source"))
    counts = []
    for shard in (6000, 200):
        rows = packing.pack(docs, F.col("n"), source=F.col("source"), capacity=100, shard_pieces=shard).collect()
        bins = {}
        for r in rows:
            bins.setdefault((r.shard, r.bin), []).append(r)
        assert len(rows) == 6000 and all(sum(r.n_words for r in b) <= 100 and len({r.source for r in b}) == len(b) for b in bins.values())
        assert all(sorted(r.position for r in b) == list(range(len(b))) for b in bins.values())
        counts.append(len(bins))
    assert counts[1] <= 1.02 * counts[0]


# -- toxicity ---------------------------------------------------------------------------------------------------------------


def labelled(spark, n=400, seed=9):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [prose(rng, 1) for _ in range(rng.randint(5, 200))]
        toxic = i % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = "vile" + rng.choice("abcdefghij") + rng.choice("klmnop")
        rows.append((i, " ".join(words), None, None, None, int(toxic)))
    table = spark.createDataFrame(rows, SCHEMA + ", toxic int")
    return table.drop("toxic"), table.select("doc_id", "toxic")


def test_unseen_forms_are_found_in_held_out_texts(spark):
    docs, labels = labelled(spark)
    network = toxicity.fit(docs, labels, learn_from=~toxicity.held_out())
    found = toxicity.scored(docs, network, ["doc_id"]).join(labels, "doc_id").filter(toxicity.held_out()).collect()
    hit = [(r["__score"] >= toxicity.THRESHOLD) == bool(r.toxic) for r in found]
    assert len(hit) > 60 and sum(hit) / len(hit) > 0.95


def test_toxicity_of_odd_rows(spark, odd, empty):
    docs, labels = labelled(spark, 120)
    marks = labels.union(spark.createDataFrame([(None, 1), (1, None), (5, 7), (10**9, 1)], "doc_id long, toxic int")).withColumn("text", F.lit("x"))
    kept = toxicity.drop_toxic(docs.unionByName(odd.select(*docs.columns).filter("doc_id IS NULL")), marks)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL").count() == 2
    scores = toxicity.scored(odd, toxicity.fit(odd, marks), ["doc_id"])
    assert scores.count() == odd.count() and scores.filter("__score IS NULL OR __score < 0 OR __score > 1 OR isnan(__score)").isEmpty()
    assert toxicity.drop_toxic(odd, marks.limit(0)).columns == odd.columns
    assert toxicity.drop_toxic(odd, marks.limit(0)).count() == odd.count()
    assert toxicity.drop_toxic(empty, marks).count() == 0


def test_every_word_is_in_a_window(texts):
    import numpy as np

    blobs = [(t or "").encode() for _, t in texts]
    t = toxicity.Tokens(np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)]))
    first, size, text = t.windows()
    seen = np.zeros(len(t.kind), bool)
    for a, n in zip(first, size):
        seen[a : a + n] = True
    assert seen.all() and set(text.tolist()) == set(range(len(blobs)))


# -- token files --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block,file", [(1 << 19, 1024), (7, 3), (1, 2), (100, 1)])
def test_token_counts_over_block_edges(docs, texts, block, file, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BLOCKS", file)
    small = docs.filter("coalesce(length(text), 0) < 3000")
    got = token_files.token_counts(small, block_tokens=block)
    assert plain(got, "doc_id", "n_tokens") == [(i, len((t or "").encode())) for i, t in texts if len(t or "") < 3000]
    ends = got.groupBy("file").agg(F.max("ordinal").alias("m"), F.count("*").alias("n"), F.countDistinct("ordinal").alias("d"))
    assert ends.filter("m + 1 <> n OR n <> d").isEmpty()


def test_token_files_are_read_in_small_pieces(spark, tmp_path):
    import pyarrow.parquet as pq

    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=3_000_000))) for i in range(4)] + [(None, "x"), (9, None)]
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), str(tmp_path / "tokens"))
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "tokens").glob("*.parquet")]
    groups = [m.row_group(k).total_byte_size for m in files for k in range(m.num_row_groups)]
    assert sum(groups) > 2 * 12_000_000 and max(groups) < 12_000_000
    found = token_files.documents(token_files.scan(spark.read.parquet(str(tmp_path / "tokens")), carry=["ended"]))
    assert plain(found, "doc_id", "n_tokens") == [(None, 1), *((i, 3_000_000) for i in range(4)), (9, 0)]


def test_scan_of_other_files(spark):
    import numpy as np

    tokens = np.array([5, 9, 9, 7, 8, 9, 4], "<u4")
    rows = [(0, k, tokens[a : a + 3].tobytes(), []) for k, a in enumerate(range(0, 7, 3))]
    found = token_files.scan(spark.createDataFrame(rows, "file long, block long, tokens binary, ended array<long>"), 9, 4, ["ended"])
    assert plain(token_files.documents(found), "ordinal", "first_token", "n_tokens") == [(0, 0, 1), (1, 2, 0), (2, 3, 2)]


def test_token_counts_of_odd_rows(odd, empty):
    assert token_files.token_counts(odd).count() == odd.count()
    assert token_files.token_counts(empty).count() == 0


# -- personal data --------------------------------------------------------------------------------------------------------------

HARD = [
    "a@b.c_d@e.f, x@y a@b-.c..d %@-.- (me@here.org.uk.)", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 999999999999.1.1.1 1.1.1.1.", "4111 1111 1111 1111",
    "4111-1111-1111-1111 0 4111111111111111", "x4111111111111111y", "+1 (555) 123-4567, +1234567 +12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+", "+1", "++12345678901",
    "é😀 a@b.c 😀 1.2.3.4", "4" * 5000, "a" * 20000 + "@", "1." * 3000, "+1" + "(" * 3000, "6011 0009 9013 9424  3530-1113-3330-0000", None, "", "a@b.c" * 50,
    "5500 0000 0000 0004 1", "55000000000000045500000000000004", "1  5500000000000004", "4111 1111-1111 1111 ", "12 4111111111111111",
]


def test_patterns_match_brute_force(spark, texts):
    rng = random.Random(2)
    alphabet = "ab@.-_+ 0123456789()%"
    rows = list(enumerate(HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(400)] + [t for _, t in texts]))
    got = sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [(sanitise.KINDS[s.kind], s.start, s.end) for s in r.base] for r in got.collect()}
    assert got == {i: brute.base_spans(t) for i, t in rows}


def test_words_that_disclose_an_entity(spark):
    rows = [(i, f"letter {i} from Zebediah near ann@example.org with regards and greetings number {i}") for i in range(3)]
    rows += [(10 + i, f"greetings and regards from other people with letter number {i} near nothing") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.doc_id: [rows[r.doc_id][1][s.start : s.end] for s in r.terms] for r in sanitise.personal_data(docs).collect() if r.terms}
    assert terms == {i: ["Zebediah"] for i in range(3)}
    text = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert text[1] == "letter 1 from [TERM] near [EMAIL] with regards and greetings number 1" and text[12] == rows[5][1]


def test_words_disclose_from_anywhere_in_the_text(spark):
    gap = "and so on with more of the same " * 8
    rows = [(i, f"Zebediah {i} {gap}ann@example.org {gap}zebediah x{i} Jo") for i in range(3)]
    rows += [(10 + i, f"{gap} {i} x{i}") for i in range(40)]
    found = sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).filter("size(terms) > 0").collect()
    assert {r.doc_id: [rows[r.doc_id][1][s.start : s.end] for s in r.terms] for r in found} == {i: ["Zebediah", "zebediah", "Jo"] for i in range(3)}


def test_sanitised_rows_of_one_id_and_without_id(spark):
    rows = [(1, "a@b.org is first"), (1, "second is a@b.org"), (1, "third"), (None, "no id: 1.2.3.4"), (None, "no id: 1.2.3.4"), (None, "c@d.org"), (2, None)]
    got = sanitise.sanitised(spark.createDataFrame(rows, "doc_id long, text string"), support=9)
    want = [(None, "[EMAIL]"), (None, "no id: [IP]"), (1, "[EMAIL] is first"), (1, "second is [EMAIL]"), (1, "third"), (2, "")]
    assert plain(got, "doc_id", "text") == want


def test_personal_data_of_odd_rows(odd, empty):
    assert sanitise.personal_data(odd).count() == odd.count()
    assert sanitise.personal_data(empty).count() == sanitise.sanitised(empty).count() == 0


# -- chat -----------------------------------------------------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be \\ good </turn>\n### user: no"), (1, 1, "user", "### assistant: x"), (1, 2, "assistant", "a\\\\#<b"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "user", "only"), (3, 0, "a:b\\", "t"), (None, 1, None, "x"), (4, 7, "assistant", "same"), (4, 7, "assistant", "same"), (4, None, "assistant", "first"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash")).withColumn("head", F.lit(1))
    segments = chat.rendered(turns)
    back = chat.read_back(segments).collect()
    want = sorted(((c is not None, c or 0), (n is not None, n or 0), r or "", t or "") for c, n, r, t in TURNS)
    got = sorted((((r.conv_id is not None, r.conv_id or 0), r.place, r.role, r.text) for r in back))
    assert [(c, r, t) for c, _, r, t in want] == [(c, r, t) for c, _, r, t in got]
    assert all(r.trained == (r.text if r.role == "assistant" else None) for r in back)
    whole = {}
    for s in sorted(segments.collect(), key=lambda s: s.place):
        whole[s.conv_id] = whole.get(s.conv_id, "") + s.segment
    for e in chat.example_texts(segments).collect():
        assert e.text == whole[e.conv_id][: e.n_chars] and e.text.endswith("</turn>\n")
    replies = {(e.conv_id, e.example): whole[e.conv_id][e.reply_start : e.reply_end] for e in chat.examples(segments).collect()}
    assert replies[(1, 2)] == "a\\\\\\\\\\#\\<b" and replies[(1, 4)] == "" and len(replies) == 5
    assert chat.rendered(turns.limit(0)).count() == 0


def test_chat_query_reads_its_examples(spark, tmp_path, monkeypatch):
    """What the query returns comes from the texts of its examples: a mark put into each shows in the results."""
    texts = [(1, k, "assistant" if k % 2 else "user", f"said {k} \\ # <") for k in range(301)] + [(2, 0, "user", "alone")]
    spark.createDataFrame(texts, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op4_prefix_target(spark, str(tmp_path)).collect()}
    loss = "".join(t for c, _, role, t in texts if role == "assistant")
    turns = "".join(f"{role}\n{t}\n" for c, _, role, t in texts if c == 1)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (301, digest(turns), len(loss), digest(loss))
    assert got[1].formatted_chars == sum(len(f"### {role}: {t}</turn>\n") + 3 for c, _, role, t in texts if c == 1)
    assert (got[2].n_turns, got[2].loss_chars, got[2].turns_sha256) == (1, 0, digest("user\nalone\n"))
    monkeypatch.setattr(chat, "expanded", lambda s, keep=chat.expanded: keep(s).withColumn("text", F.regexp_replace("text", "said 1 ", "heard ")))
    marked = {r.conv_id: r for r in chat.op4_prefix_target(spark, str(tmp_path)).collect()}
    assert marked[1].turns_sha256 != got[1].turns_sha256 and marked[1].loss_sha256 != got[1].loss_sha256 and marked[2] == got[2]


# -- URLs -----------------------------------------------------------------------------------------------------------------------


def test_urls_are_judged_at_their_time(spark):
    entries = [
        ("a", "Bad.example", "add", 100), ("a", "bad.example", "remove", 200), ("a", "bad.example", "add", 300), ("b", "x.org/p/", "add", 0), ("b", "x.org/p/q", "add", 50),
        ("b", "tie.org", "add", 10), ("b", "tie.org", "remove", 10), ("b", None, "add", 1), ("b", "ok.org", "add", None), ("b", "ok.org", "block", 1), ("c", "bad.example", "add", 150),
    ]
    rows = [
        ("http://bad.example/", 99, []), ("http://bad.example", 100, ["a"]), ("https://www.BAD.example:80/x?y", 199, ["a", "c"]), ("http://bad.example/", 250, ["c"]),
        ("http://u@bad.example./", 10**9, ["a", "c"]), ("http://notbad.example/", 150, []), ("http://x.org/p/q", 60, ["b", "b"]), ("http://x.org/p/q/r#s", 60, ["b"]), ("http://x.org/pp", 60, []),
        ("http://tie.org", 20, []), ("http://ok.org", 20, []), (None, 100, []), ("junk", 100, []), ("http://bad.example/", None, []), ("http://bad.example", 100, ["a"]),
    ]
    captures = spark.createDataFrame([(u, t, k) for k, (u, t, _) in enumerate(rows)], "url string, fetched_at long, entry long").withColumn("key", F.col("entry"))
    entries = spark.createDataFrame(entries, "list string, pattern string, action string, at long")
    for bucket in (30, 86400):
        got = {r.key: (r.blocked, r.n_entries) for r in url_filter.judge(captures, entries, bucket=bucket).collect()}
        assert got == {k: (bool(w), len(w)) for k, (_, _, w) in enumerate(rows)}
    assert url_filter.judge(captures, entries.limit(0)).filter("blocked").isEmpty() and url_filter.judge(captures.limit(0), entries).isEmpty()
    assert T.BooleanType() == url_filter.judge(captures, entries).schema["blocked"].dataType


def test_paths_of_patterns_keep_their_case(spark):
    rows = [("http://Case.example/Blog/x", True), ("http://case.example/blog/x", False), ("http://case.example/Blog/", True)]
    captures = spark.createDataFrame([(u, 10, w) for u, w in rows], "url string, fetched_at long, want boolean")
    entries = spark.createDataFrame([("a", "CASE.example/Blog/", "add", 1), ("a", "case.example/blog/", "remove", 5)], "list string, pattern string, action string, at long")
    assert url_filter.judge(captures, entries).filter("blocked <> want").isEmpty()


def test_very_long_urls_cost_their_length(spark):
    """100,000 path parts, whole, listed by a shallow and by a deep folder."""
    import time

    deep = "/" + "/".join(str(k % 10) for k in range(100_000))
    folder = "/" + "/".join(str(k % 10) for k in range(90_000)) + "/"
    rows = [("http://deep.example" + deep, 3), ("http://deep.example" + deep[:-1] + "x", 2), ("http://other.example" + deep, 0), ("http://deep.example/0/x", 1)]
    captures = spark.createDataFrame([(u, 10, n) for u, n in rows], "url string, fetched_at long, want long")
    entries = spark.createDataFrame([("a", "deep.example/0/", "add", 1), ("a", "deep.example" + folder, "add", 1), ("a", "deep.example" + deep, "add", 1)],
                                    "list string, pattern string, action string, at long")
    began = time.monotonic()
    assert url_filter.judge(captures, entries).filter("n_entries <> want").isEmpty()
    assert time.monotonic() - began < 60
