"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and extra columns."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, hamming_search, html_extract, kneser_ney, line_dedup, pii, quality, sentencepiece_viterbi, shared, simhash, tool_calls

DOCS = "doc_id long, text string, component_id string, fp string, kept int, n int, score string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def docs_of(spark, rows):
    """With columns whose names clash with those that the operators use."""
    return spark.createDataFrame([(i, t, "c", "f", 1, 2, "s") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [words(rng, rng.randint(30, 80)) for _ in range(25)]
    rows = list(enumerate(base))
    for k, t in enumerate(base[:10]):
        w = t.split()
        w[3] = "changed"
        rows += [(100 + k, t), (200 + k, " ".join(w)), (300 + k, t.upper())]
    return rows + [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (403, "one two"), (404, words(rng, 30_000))]


# ------------------------------------------------------------------ shared


def test_components_are_the_smallest_reachable(spark):
    edges = [(5, 4), (4, 3), (9, 8), (8, 3), (20, 21), (7, 7)]
    got = dict(map(tuple, shared.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {3: 3, 4: 3, 5: 3, 8: 3, 9: 3, 20: 20, 21: 20}
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_long_chain(spark):
    got = shared.components(spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long")).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 201


# ------------------------------------------------------------------ op 9


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, links):
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            if of[a] != low or of[b] != low:
                of[a] = of[b] = low
                changed = True
    return of


def test_simhash_equals_brute_force(spark, corpus):
    got = simhash.near_duplicates(docs_of(spark, corpus), block=8).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in corpus]
    links = [(a, b) for (a, x), (b, y) in combinations(prints, 2) if (x ^ y).bit_count() <= 4]
    groups = plain_components([i for i, _ in prints], links)
    assert sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == sorted((i, p, groups[i]) for i, p in prints)


def test_simhash_forest_on_random_prints():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    fps = np.unique(np.concatenate([fps, fps[:100] ^ np.uint64(0b111), fps[:50] ^ (np.uint64(1) << np.uint64(60))]))
    for same, right in ((True, np.zeros(len(fps), bool)), (False, np.arange(len(fps)) % 2 == 1)):
        got = simhash.forest(fps, right, same, 4, tile=16)
        links = [(a, b) for a, b in combinations(range(len(fps)), 2) if int(fps[a] ^ fps[b]).bit_count() <= 4 and (same or right[a] != right[b])]
        assert got.tolist() == list(plain_components(range(len(fps)), links).values())


def test_simhash_keeps_one(spark, corpus):
    frame = docs_of(spark, [*corpus, (None, "no id")])
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    groups = {r["component_id"] for r in simhash.near_duplicates(docs_of(spark, corpus)).collect()}
    assert set(ids) == groups and kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_simhash_stage_links_what_is_similar(spark):
    """Texts of every length with a few changed words: the same groups as brute force over their shingle sets."""
    import corpus_pipeline

    rng = random.Random(21)
    base = [words(rng, n) for n in [8, 20, 60, 90, 150, 300] * 4]
    rows = list(enumerate(base))
    for k, t in enumerate(base):
        w = t.split()
        for at in range(k % 3, len(w), len(w) // (1 + len(w) // 60) + 1):
            w[at] = f"other{k}"
        rows += [(100 + k, " ".join(w)), (200 + k, t + " and more"), (300 + k, t.upper())]
    rows += [(400, None), (401, ""), (402, "one two"), (403, "one two"), (404, "one three")]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    alike = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b) > 0
    links = [(i, j) for i, j in combinations(sets, 2) if alike(sets[i], sets[j])]
    far = {i: simhash.majority(simhash.text_hashes(t or "")) for i, t in rows}
    assert any((far[i] ^ far[j]).bit_count() > 4 for i, j in links)
    groups = plain_components(sets, links)
    for block in (7, 65_536):
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs_of(spark, rows), 5, 80, block=block).collect()}
        assert got == groups
    kept = corpus_pipeline.one_of_each(spark, docs_of(spark, [*rows, (None, "no id")]), "")
    assert {r["doc_id"] for r in kept.collect()} == {*groups.values(), None}
    assert simhash.similar(docs_of(spark, []), 5, 80).count() == 0


# ------------------------------------------------------------------ op 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_links(spark, lines):
    """Pairs of normalised lines that share a block, are within the radius and have the edit similarity."""
    table = spark.createDataFrame([(x,) for x in lines], "norm string").withColumn("line", F.col("norm"))
    made = line_dedup.with_blocks(table).collect()
    prints = {r["k1"]: r["fp"] for r in line_dedup.line_simhash(table.select(F.xxhash64("norm").alias("k1"), "norm")).collect()}
    blocks, fp = {r["line"]: set(r["blocks"]) for r in made}, {r["line"]: prints.get(r["k1"]) for r in made}
    out = []
    for a, b in combinations(lines, 2):
        if not blocks[a] & blocks[b]:
            continue
        reach = line_dedup.FEW_RADIUS if min(a.count(" "), b.count(" ")) < line_dedup.FEW else line_dedup.RADIUS
        if fp[a] is not None and fp[b] is not None and ((fp[a] ^ fp[b]) % 2**64).bit_count() > reach:
            continue
        n, changed = max(len(a.split(" ")), len(b.split(" "))), distance(a.split(" "), b.split(" "))
        if n > line_dedup.SHORT and (5 * changed <= n or changed > line_dedup.MOST_WORDS * n):
            out += [(a, b)] * (5 * changed <= n)
        elif distance(a, b) <= max(len(a), len(b)) // 5:
            out.append((a, b))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    base = [words(rng, 40) for _ in range(12)]
    near = [" ".join(["swap" if k == 7 else w for k, w in enumerate(t.split())]) for t in base]
    rows = [(k, "\n".join([base[k], "", near[(k + 1) % 12], "Common  line."])) for k in range(12)]
    rows += [(50, "COMMON line."), (51, None), (52, ""), (None, base[0]), (53, "x\n\nx"), (54, "| | |\n| | |"), (50, "COMMON line.")]
    frame = docs_of(spark, rows)
    done = line_dedup.dedup_lines(frame)
    assert done.columns == [*frame.columns, "n_lines", "n_kept"]
    # brute force over all pairs of normalised lines, with the fingerprints of the operator
    normal = lambda line: re.sub(r"\s+", " ", line.strip(" ").lower()).strip()
    occurrences = sorted(
        {(-(2**63) if i is None else i, t or "", k, normal(line)) for i, t in rows for k, line in enumerate((t or "").split("\n")) if normal(line)},
        key=lambda o: (o[0], 0, o[2]),
    )
    lines = sorted({o[3] for o in occurrences})
    links = plain_links(spark, lines)
    assert links
    groups, first = plain_components(lines, links), {}
    for i, t, k, line in occurrences:
        first.setdefault(groups[line], (i, t, k))
    kept = {(i, t, k) for i, t, k, line in occurrences if first[groups[line]] == (i, t, k)}
    for row in done.collect():
        i = -(2**63) if row["doc_id"] is None else row["doc_id"]
        source = [t or "" for d, t in rows if d == row["doc_id"]][0]
        want = [x for k, x in enumerate(source.split("\n")) if not normal(x) or (i, source, k) in kept]
        assert row["text"] == "\n".join(want) and row["n_kept"] == len(want) and row["n_lines"] == source.count("\n") + 1
    assert done.count() == len(rows)
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_tiles_hold_every_pair_that_is_apart(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = [None if k % 17 == 0 else base[k % 6] ^ sum(1 << b for b in rng.sample(range(64), k % 11)) for k in range(70)]
    rows = [(k % 2, k, k // 3, None if x is None else x - 2**64 if x >> 63 else x, None if x is None else 16) for k, x in enumerate(fps)]
    texts = spark.createDataFrame([(k, 100, 10, "abcdefghij"[: 10 - k % 3 // 2]) for k in range(70)], "k1 long, size int, words int, code string")
    got = {tuple(r) for r in line_dedup.tiled(spark.createDataFrame(rows, "key long, k1 long, g long, fp long, reach int"), texts, 8).collect()}
    near = lambda x, y: x is None or y is None or (x ^ y).bit_count() <= line_dedup.CLOSE
    assert got == {(a[1], b[1]) for a, b in combinations(rows, 2) if a[0] == b[0] and a[2] != b[2] and near(fps[a[1]], fps[b[1]])}


def test_line_dedup_recall_at_an_edit_similarity_of_080(spark):
    """Of all pairs that brute force finds by characters, nine of ten are in one group; others are in none."""
    rng, lines = random.Random(8), []
    for _ in range(40):
        w = words(rng, rng.choice([4, 7, 12, 30, 60])).split()
        for share in (0, 0.04, 0.08, 0.12):
            lines.append(" ".join(words(rng, 1) if share and rng.random() < share else x for x in w))
    lines = sorted(set(lines))
    docs = docs_of(spark, enumerate(lines))
    found, _ = line_dedup.fuzzy_links(docs, line_dedup.with_blocks(line_dedup._occurrences(docs)))
    group = {r["node"]: r["component"] for r in found.collect()}
    key = dict(map(tuple, docs.select("text", F.xxhash64("text")).collect()))
    of = {x: group.get(key[x], key[x]) for x in lines}
    pairs = [(a, b) for a, b in combinations(lines, 2) if abs(len(a) - len(b)) * 5 <= max(len(a), len(b)) and distance(a, b) <= max(len(a), len(b)) // 5]
    assert len(pairs) > 100 and sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_line_blocks_hold_every_similar_pair(spark):
    """Words changed at equal distances, words put in or left out, and lines of few words with changes all over share a block."""
    rng, pairs = random.Random(21), []
    for n in range(9, 70):
        w = words(rng, n).split()
        for first in (0, 2, 4):
            cut = [f"new{k}" if k % 5 == first and k // 5 < n // 5 else x for k, x in enumerate(w)]
            pairs.append((" ".join(w), " ".join(cut)))
        pairs.append((" ".join(w), " ".join(x for k, x in enumerate(w) if k % 5 != 3 or k // 5 >= n // 5)))
        if n <= 24:
            wide = [f"a-very-long-word-{x}" for x in w]
            pairs.append((" ".join(wide), " ".join(x + "s" if k % 5 in (1, 3) else x for k, x in enumerate(wide))))
    pairs += [("the of.", "the or."), ("abcd", "abcde"), ("one two tree four", "ones two three four"), ("in the of and by", "an the of end by")]
    pairs.append(("aaaaaaaaaaaa bbbbbbbbbbbb cccccccccccc dddddddddddd eeeeeeeeeeee ffffffffffff", "a aaaaaaaaaaaa bbbbbbbbbbbb b cccccccccccc dddddddddddd d eeeeeeeeeeee ffffffffffff"))
    table = spark.createDataFrame([(x,) for x in {x for pair in pairs for x in pair}], "norm string").withColumn("line", F.col("norm"))
    blocks = {r["line"]: set(r["blocks"]) for r in line_dedup.with_blocks(table).collect()}
    for a, b in pairs:
        n = max(a.count(" "), b.count(" ")) + 1
        assert distance(a, b) * 5 <= max(len(a), len(b)) or n > line_dedup.SHORT and distance(a.split(" "), b.split(" ")) * 5 <= n
        assert blocks[a] & blocks[b], (a, b)


def test_lines_apart_by_their_fingerprints_are_linked(spark):
    """Lines of one block that are similar in words or in characters are in one group however many bits they differ in."""
    rng, pairs = random.Random(31), []
    for n in (10, 15, 20):
        for _ in range(10):
            w = [f"long-enough-{x}" for x in words(rng, n).split()]
            pairs.append((" ".join(w), " ".join(x + "s" if k % 5 in (1, 3) else x for k, x in enumerate(w))))
            pairs.append((" ".join(w[::-1]), " ".join("other" if k % 5 == 2 else x for k, x in enumerate(w[::-1]))))
    lines = sorted({x for pair in pairs for x in pair})
    docs = docs_of(spark, enumerate(lines))
    table = docs.select(F.xxhash64("text").alias("k1"), F.col("text").alias("norm"))
    prints = {r["k1"]: r["fp"] for r in line_dedup.line_simhash(table).collect()}
    key = dict(map(tuple, docs.select("text", F.xxhash64("text")).collect()))
    assert any(((prints[key[a]] ^ prints[key[b]]) % 2**64).bit_count() > line_dedup.FEW_RADIUS for a, b in pairs)
    found, _ = line_dedup.fuzzy_links(docs, line_dedup.with_blocks(line_dedup._occurrences(docs)))
    group = {r["node"]: r["component"] for r in found.collect()}
    assert all(group.get(key[a], a) == group.get(key[b], b) for a, b in pairs)


def test_short_lines_meet_in_tiles(spark):
    """Tiles of a few lines give the pairs of different groups that brute force over characters gives, each once."""
    rng, lines = random.Random(41), set()
    for n in (1, 2, 3, 5, 8):
        for _ in range(6):
            w = words(rng, n)
            at = rng.randrange(len(w))
            lines |= {w, w + "s", w[:at] + "x" + w[at + 1 :], w[:at] + w[at + 2 :]}
    lines = sorted({" ".join(x.split()) for x in lines})
    table = spark.createDataFrame([(x,) for x in lines], "norm string").select(F.xxhash64("norm").alias("k1"), "norm")
    short = line_dedup.short_lines(line_dedup.described(table)).withColumn("g", F.when(F.col("norm").startswith("a"), F.lit(0)).otherwise(F.col("k1")))
    key = {r["norm"]: r["k1"] for r in table.collect()}
    group = {x: 0 if x.startswith("a") else key[x] for x in lines}
    want = {tuple(sorted((key[a], key[b]))) for a, b in combinations(lines, 2) if group[a] != group[b] and distance(a, b) <= max(len(a), len(b)) // 5}
    for tile in (3, 2_048):
        got = [tuple(r) for r in line_dedup.short_links(short, tile).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_short_lines_without_a_common_piece_do_not_meet(spark):
    """Few of all pairs of one length are compared, and every similar one among them."""
    rng = random.Random(43)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20)) for _ in range(300)]
    edited = [x[:3] + "-" + x[3:9] + x[10:15] + "+" + x[16:] + "." for x in lines[:40]]
    table = spark.createDataFrame([(x,) for x in lines + edited], "norm string").select(F.xxhash64("norm").alias("k1"), "norm")
    key = {r["norm"]: r["k1"] for r in table.collect()}
    short = line_dedup.short_lines(line_dedup.described(table)).withColumn("g", F.col("k1"))
    met = {tuple(r) for r in line_dedup.short_pairs(short).collect()}
    assert {tuple(sorted((key[a], key[b]))) for a, b in zip(lines, edited)} <= met and len(met) < 100


def test_tiles_tell_lines_of_repeated_words_apart(spark):
    """Of lines of one block that repeat a word, only those leave the tiles that have enough words in common; no text goes in."""
    lines = [" ".join(["shared", "words"] + [f"w{k}"] * 100) for k in range(20)] + [" ".join(["shared", "words"] + ["w1"] * 90 + ["w2"] * 10)]
    table = spark.createDataFrame([(x,) for x in lines], "norm string").select(F.xxhash64("norm").alias("k1"), "norm")
    told = line_dedup.line_marks(table).join(line_dedup.line_counts(line_dedup.described(table)), "k1", "left")
    rows = told.select(F.lit(1).cast("long").alias("key"), "k1", F.col("k1").alias("g"))
    key = {r["norm"]: r["k1"] for r in table.collect()}
    got = {tuple(r) for r in line_dedup.tiled(rows, told, 8).collect()}
    buckets = {k: r["h"] for k, r in enumerate(spark.range(20).select((F.xxhash64(F.concat(F.lit("w"), F.col("id"))).bitwiseAND(F.lit(line_dedup.BUCKETS - 1))).alias("h")).collect())}
    apart = {(a, b) for a, b in combinations(range(20), 2) if buckets[a] != buckets[b]}
    assert tuple(sorted((key[lines[1]], key[lines[20]]))) in got and len(apart) > 150
    assert not any(tuple(sorted((key[lines[a]], key[lines[b]]))) in got for a, b in apart)


def test_line_dedup_keeps_clashing_columns(spark):
    frame = docs_of(spark, [(1, "a b c"), (2, "A  B c"), (3, "a\x0bb\x0cc")]).withColumn("n_lines", F.lit(9)).withColumn("gone", F.lit("g"))
    rows = {r["doc_id"]: r for r in line_dedup.shorten(frame).collect()}
    assert [rows[k]["text"] for k in (1, 2, 3)] == ["a b c", "", ""] and all(r["n_lines"] == 9 and r["gone"] == "g" for r in rows.values())
    done = line_dedup.dedup_lines(frame)
    assert sorted(done.columns) == sorted([*frame.columns, "n_kept"]) and done.columns[-2:] == ["n_lines", "n_kept"]


def test_line_dedup_stays_in_the_jvm(spark):
    plan = line_dedup.dedup_lines(docs_of(spark, [(1, "a b c\na b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ op 3


def test_search_recall_and_order(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[500] = x[40]
    x = x.astype(np.float32)
    rows = [(k, [float(v) for v in row], 1) for k, row in enumerate(x)]
    odd = [(1000, None, 1), (1020, [0.0] * 64, 1), (1040, [1.0, None] * 32, 1), (1060, [float("nan")] * 64, 1), (1080, [1.0], 1), (None, [1.0] * 64, 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in hamming_search.search(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        scores = x.astype(float) @ x[q].astype(float)
        scores[q] = -9
        best = set(np.argsort(-scores, kind="stable")[:20].tolist())
        hits += len(best & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in found) and found == sorted(found, key=lambda f: (-f[2], f[1]))
    assert hits / (20 * len(got)) >= 0.9


def test_block_retrieves_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 1 << 16, (400, 8), dtype=np.uint16)
    block = hamming_search.Block(codes)
    for radius in (10, 40, 55, 64):
        distance = np.bitwise_count(codes ^ codes[7]).sum(axis=1)
        assert block.within(codes[7], radius).tolist() == np.flatnonzero(distance <= radius).tolist()


def test_search_with_repeated_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(rng.normal(size=(70, 16)))]
    frame = spark.createDataFrame(rows + [rows[20], rows[5]], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in hamming_search.search(frame).where("query_id = 20").orderBy("rank").collect()]
    x = np.array([v for _, v in rows], np.float32).astype(float)
    order = sorted((-(x[k] @ x[20]), k) for k in [*range(70), 5] if k != 20)[:20]
    assert [g[1] for g in got] == list(range(1, 21)) and [g[2] for g in got] == [k for _, k in order]


def test_search_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r)[:3] for r in hamming_search.search(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 3), (0, 3, 20), (20, 1, 2), (20, 2, 3), (20, 3, 0)]
    assert hamming_search.search(few.where("false")).count() == 0


# ------------------------------------------------------------------ op 1


def test_main_text_of_a_full_page():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav><!-- ad -->"
        "<div class='ad'>Buy <b>now</b></div><article><h1>A &amp; B</h1><p><b>First  line<br>of\ntext &#233;</p><p>Short.<div class=\"advert\">ad</div><p>Last <a href=y>link</a>.</p>"
        "</article><section id=comments><p>" + "Nice text, really nice text indeed. " * 9 + "</p></section><footer>&copy; x</footer></body></html>"
    )
    assert html_extract.main_text(page) == "A & B\nFirst line\nof text é\nShort.\nLast link."


def test_main_text_without_article_keeps_the_surge():
    long = "A sentence of the article that goes on for a while, as such sentences do. " * 2
    page = f"<body><div><a href=1>one</a> <a href=2>two</a></div><div>{long}</div><div>{long}</div><div>Short end.</div><ul class=menu><li>x</ul><form>Name</form>"
    assert html_extract.main_text(page).split("\n") == [long.strip(), long.strip(), "Short end."]


LONG = "A sentence of the article that goes on for a while, as such sentences do. " * 2


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p class=ad>Buy now<p>" + LONG, LONG.strip()),
        ("<ul><li class=menu>Home<li>" + LONG + "</ul>", LONG.strip()),
        ("<table><tr><td class=menu>Home<td>" + LONG + "<tr><td class=ad>x</table>", LONG.strip()),
        ("<dl><dt class=ad>x<dd>" + LONG, LONG.strip()),
        (f"<div>{LONG}<div class=advert>Buy</div>Short closing line.</div>", LONG.strip() + "\nShort closing line."),
        (f"<div>{LONG}</div><aside>Other</aside><div><a href=x>more</a> of it</div>", LONG.strip()),
        (f"<div>{LONG}</div><aside>Other</aside><article><h2>Head</h2><p>{LONG}</p><div class=ad>ad</div><p>End.</p></article>", f"Head\n{LONG.strip()}\nEnd."),
        (f"<p>{LONG}</p><p>with <math><mi>x</mi></math> and <svg><text>label</text></svg>", LONG.strip() + "\nwith x and label"),
    ],
)
def test_main_text_by_windows_and_implied_ends(html, want):
    assert html_extract.main_text(html) == want


def test_main_text_does_not_need_the_wrappers(spark):
    strip = lambda h: re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", h, flags=re.I)
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert html_extract.main_text(row["html"]) == html_extract.main_text(strip(row["html"])) != ""


def test_identifiers_are_exact_beside_nulls(spark):
    """Beyond 2^53 and with a null in the batch, in every operator that goes through Python."""
    big = 2**53 + 1
    frame = docs_of(spark, [(big, "one two three"), (None, "four five"), (big + 2, None)])
    want = {big, None, big + 2}
    ids = lambda df, name="doc_id": {r[name] for r in df.collect()}
    labels = spark.createDataFrame([(big, 1)], "doc_id long, quality int")
    tests = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    assert ids(quality.scored(frame, labels)) == want and ids(sentencepiece_viterbi.encoded(frame)) == want
    assert ids(decontaminate.mark(frame, tests)) == want and ids(decontaminate.remove(frame, tests)) == want
    assert ids(kneser_ney.score(frame, kneser_ney.train(frame))) == want and ids(pii.find(frame)) == want
    assert ids(simhash.near_duplicates(frame)) == want and ids(simhash.keep_one(frame, size=5, percent=80)) == want
    pages = spark.createDataFrame([(big, "u", "a"), (None, "u", "b")], "page_id long, url string, html string")
    assert ids(html_extract.extract(pages), "page_id") == {big, None}
    hit = decontaminate.overlaps(docs_of(spark, [(big, "alpha beta gamma delta epsilon"), (None, "x")]), tests).collect()
    assert [r["doc_id"] for r in hit] == [big]


def test_stages_keep_clashing_columns(spark):
    frame = docs_of(spark, [(1, "alpha beta gamma delta epsilon"), (2, "clean text")])
    for name in ("bad_id", "id", "tkey", "row", "here", "pieces"):
        frame = frame.withColumn(name, F.lit("own"))
    tests = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    left = decontaminate.remove(frame, tests)
    assert left.columns == frame.columns and [(r["doc_id"], r["bad_id"], r["row"]) for r in left.collect()] == [(2, "own", "own")]
    out = sentencepiece_viterbi.with_pieces(frame)
    assert out.columns.count("pieces") == 1 and all(len(r["pieces"]) for r in out.collect())


def test_html_edges(spark):
    rows = [(1, "u", None, 1), (2, None, "", 1), (3, "u", "<p>only", 1), (3, "u", "<p>only", 1), (None, "u", "plain", 1), (4, "u", "<p>x" * 20_000, 1), (5, "u", "<p>cut <foo", 1)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {(r["page_id"]): r["text"] for r in got}
    assert len(got) == 7 and by[1] == by[2] == "" and by[3] == "only" and by[None] == "plain" and by[5] == "cut" and by[4].count("\n") == 19_999
    assert all(r["n_chars"] == len(r["text"]) for r in got)


# ------------------------------------------------------------------ op 4

SCHEMA = {"f": {"properties": {"a": "string", "n": "integer", "on": "boolean", "xs": "array"}, "required": ["a"]}}


def link(spark, calls, results):
    c = spark.createDataFrame(calls, "scope string, call_id string, position long, name string, arguments string, after array<string>")
    r = spark.createDataFrame(results, "scope string, call_id string, position long, content string")
    return {x["call_id"]: x for x in tool_calls.link(c, r, SCHEMA).collect()}, c, r


def test_tool_calls_are_linked_ordered_and_checked(spark):
    calls = [
        ("s", "1", 1, "f", '{"n": 1, "a": "é\\"x"}', []), ("s", "2", 2, "f", '{"a": 1}', ["1"]), ("s", "3", 3, "f", '{"b": "x", "a": "y"}', ["2", "nowhere"]),
        ("s", "4", 4, "f", '{"a": "x", "on": true, "xs": [1]}', ["3", "1"]), ("s", "5", 5, "g", '{"a": "x"}', ["4"]), ("s", "6", 6, "f", "no json", ["7"]),
        ("s", "7", 7, "f", '{"a": ""}', ["6"]), ("s", "8", 8, "f", None, ["7"]), ("s", "1", 9, "f", "{}", None), (None, "9", 1, "f", "{}", []), ("s", "9", 9, "f", '["a"]', None),
    ]
    got, c, r = link(spark, calls, [("s", "1", 5, "later"), ("s", "1", 4, "first"), ("s", "4", 5, None), ("s", "99", 5, "orphan")])
    assert {k: x["level"] for k, x in got.items()} == {"1": 0, "2": 1, "3": 2, "4": 3, "5": 4, "6": None, "7": None, "8": None, "9": 0}
    assert [k for k, x in sorted(got.items()) if x["valid"]] == ["1", "4"]
    assert got["1"]["json"] == '{"arguments":{"a":"é\\"x","n":1},"id":"1","level":0,"name":"f","result":"first"}'
    assert got["1"]["n_calls"] == 2 and got["1"]["n_results"] == 2 and got["4"]["linked"] and not got["2"]["linked"]
    assert [tuple(x) for x in tool_calls.orphans(c, r).collect()] == [("s", 1)]


def test_tool_calls_on_long_chains_and_nothing(spark):
    chain = [("s", str(k), k, "f", '{"a":"x"}', [str(k - 1)]) for k in range(300)]
    got, _, _ = link(spark, chain, [])
    assert all(got[str(k)]["level"] == k for k in range(300))
    assert link(spark, [], [])[0] == {}
    plan = tool_calls.op4_tool_calls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ op 5


def test_quality_separates_and_holds_out(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        t = words(rng, rng.randint(5, 200))
        rows.append((k, t if good else " ".join(w.upper() + rng.choice(["!!", "###", "$$$"]) for w in t.split())))
        labels.append((k, int(good), "x"))
    rows += [(1000, None), (1001, ""), (1001, ""), (1002, words(rng, 50_000))]
    marks = spark.createDataFrame([*labels, (1, None, "x"), (2, 7, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    got = quality.scored(docs_of(spark, rows), marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in got if r["doc_id"] < 400)
    kept = quality.keep_good(docs_of(spark, rows), marks)
    assert kept.columns == docs_of(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] < 400} == {k for k in range(400) if k % 3}


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.scored(docs_of(spark, [(1, "a"), (2, None)]), none).collect()} == {0.5}
    assert quality.scored(docs_of(spark, []), none).count() == 0


# ------------------------------------------------------------------ op 6


def unigram_library():
    """The library with the same pieces and scores, told that the model is of the unigram kind."""
    import sentencepiece
    from pathlib import Path

    def number(data, at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    def fields(data):
        at = 0
        while at < len(data):
            begin = at
            key, at = number(data, at)
            if key & 7 == 2:
                n, at = number(data, at)
                yield key >> 3, data[at : at + n], data[begin : at + n]
                at += n
            else:
                at = number(data, at)[1] if key & 7 == 0 else at + (8 if key & 7 == 1 else 4)
                yield key >> 3, None, data[begin:at]

    def size(n):
        return bytes([n & 127 | 128]) + size(n >> 7) if n > 127 else bytes([n])

    model, out = Path(sentencepiece_viterbi.default_model()).read_bytes(), b""
    for key, body, raw in fields(model):
        if key == 2:
            body = b"".join(r for k, _, r in fields(body) if k != 3) + bytes([3 << 3, 1])
            raw = bytes([2 << 3 | 2]) + size(len(body)) + body
        out += raw
    return sentencepiece.SentencePieceProcessor(model_proto=out), sentencepiece_viterbi.Pieces(model)


def test_viterbi_is_no_worse_than_the_library_and_decodes(spark):
    library, pieces = unigram_library()
    rng = random.Random(8)
    texts = [words(rng, 30) for _ in range(40)] + ["The quick brown fox jumps", "Le café est très bon", "x", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for text, ids in zip(texts, pieces.encode(texts)):
        # the library adds in single precision and may miss the greatest total, never exceed it
        total = lambda found: sum(library.get_score(int(i)) for i in found)
        assert total(ids) >= total(library.encode(text)) and library.decode(ids.tolist()) == text
    odd = ["", " ", "  two  spaces ", "line\nbreak\ttab", "日本語 \U0001f600 ß", "a" * 5000, "\x00\x7f"]
    assert [pieces.decode(i) for i in pieces.encode(odd)] == odd


def test_merges_equal_the_library(spark):
    import sentencepiece

    model = open(sentencepiece_viterbi.default_model(), "rb").read()
    library, pieces = sentencepiece.SentencePieceProcessor(model_proto=model), sentencepiece_viterbi.Pieces(model, "merges")
    rng = random.Random(15)
    texts = [words(rng, 30) for _ in range(40)] + ["The quick brown fox jumps over", "Le café  est très bon\nligne", "日本語 \U0001f600 ß", "a" * 100, "", " x "]
    assert [ids.tolist() for ids in pieces.encode(texts)] == library.encode(texts)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sample = [r["text"] for r in docs.collect()]
    assert [ids.tolist() for ids in pieces.encode(sample)] == library.encode(sample)


def test_viterbi_equals_brute_force():
    _, pieces = unigram_library()
    score = {int(h): float(s) for h, s in zip(pieces.hashes, pieces.scores)}
    by_id = {int(i): float(s) for i, s in zip(pieces.ids, pieces.scores)}

    def best(word):
        top = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            for b in range(e):
                top[e] = max(top[e], top[b] + score.get(pieces._hash(word[b:e]), -np.inf))
        return top[-1]

    rng = random.Random(9)
    for word in ["".join(rng.choices("abcdethr", k=rng.randint(1, 9))) for _ in range(60)]:
        assert sum(by_id[int(i)] for i in pieces.best([word])[0]) == best(word)


def test_sentencepiece_edges(spark):
    rows = [(1, None), (2, ""), (3, "a\nb"), (3, "a\nb"), (None, "x ▁ y"), (4, "long " * 30_000)]
    got = sentencepiece_viterbi.encoded(docs_of(spark, rows)).collect()
    assert len(got) == 6 and all(r["round_trip"] for r in got) and {r["n_pieces"] for r in got if r["doc_id"] in (1, 2)} == {0}
    more = sentencepiece_viterbi.with_pieces(docs_of(spark, rows))
    assert more.columns[-1] == "pieces" and {r["doc_id"]: r["text"] for r in more.collect()}[3] == "a\nb"
    assert sentencepiece_viterbi.encoded(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ op 7


def test_decontamination_finds_substituted_passages_only(spark):
    rng = random.Random(10)
    items = [words(rng, n) for n in (40, 25, 16, 12, 7, 3)]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)] + [(90, None, "x"), (None, "q", "x")], "item_id long, text string, doc_id string")
    swap = lambda t: " ".join("zzz" if k % 9 == 4 else w for k, w in enumerate(t.split()))
    rows = [(k, f"{words(rng, 50)} {items[k].upper()}, {words(rng, 40)}") for k in range(6)]
    rows += [(10, words(rng, 30) + " " + swap(items[0]) + " " + words(rng, 9)), (11, swap(items[2])), (12, None), (13, ""), (14, words(rng, 20_000)), (14, items[1])]
    rows += [(20 + k, words(rng, 60)) for k in range(20)] + [(None, items[1])]
    got = decontaminate.mark(docs_of(spark, rows), bench).collect()
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["item_ids"]) for r in got if r["contaminated"])
    assert found == [(-1, [1]), (0, [0]), (1, [1]), (2, [2]), (3, [3]), (4, [4]), (5, [5]), (10, [0]), (11, [2]), (14, [1])] and len(got) == len(rows)
    left = decontaminate.remove(docs_of(spark, rows), bench)
    assert left.columns == docs_of(spark, rows).columns and left.count() == len(rows) - 10
    assert decontaminate.mark(docs_of(spark, rows[:3]), bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.mark(docs_of(spark, []), bench).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(11)
    items = [words(rng, 20) for _ in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)
    got = decontaminate.mark(docs_of(spark, list(enumerate(items))), bench).collect()
    assert all(r["item_ids"] == [r["doc_id"]] for r in got)


@pytest.mark.parametrize("n", range(5, 14))
def test_every_admitted_arrangement_is_found(n):
    """All substitutions that IDENTITY admits in items of up to a window's tokens, and no more than these."""
    rng = random.Random(n)
    item = [f"w{rng.random()}".replace(".", "x") for _ in range(n)]
    most = max(k for k in range(n) if n - k >= decontaminate.IDENTITY * n - 1e-9)
    index = decontaminate.SeedIndex([(1, " ".join(item))])
    for k in range(most + 2):
        for lost in combinations(range(n), k):
            w = np.array([0, 0, *[0 if at in lost else index.vocabulary[x] for at, x in enumerate(item)], 0], np.int64)
            hits = index.hits(w, np.array([0]))
            found = [h for h in hits.tolist() if index.verify(w, h[0], h[1], 0, len(w) - 1)]
            assert bool(found) == (k <= most), lost


def test_windows_of_long_items_are_found():
    """A window with two substitutions anywhere in a longer item, cut from it."""
    item = [f"v{k}" for k in range(30)]
    index = decontaminate.SeedIndex([(1, " ".join(item))])
    for begin in (0, 9, 17):
        for lost in combinations(range(13), 2):
            w = np.array([0, *[0 if k in lost else index.vocabulary[item[begin + k]] for k in range(13)], 0], np.int64)
            # part of the item lies outside the text: here the text has unknown tokens around
            w = np.concatenate([np.zeros(30, np.int64), w, np.zeros(30, np.int64)])
            assert any(index.verify(w, h[0], h[1], 0, len(w) - 1) for h in index.hits(w, np.array([0])).tolist()), lost


# ------------------------------------------------------------------ op 8


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_equals_brute_force(spark, order):
    rng = random.Random(12)
    rows = [(k, " ".join(rng.choices(["a", "B", "c", "dd", "e", "ff"], [9, 5, 3, 2, 1, 1], k=rng.randint(0, 25)))) for k in range(60)] + [(70, None), (71, ""), (71, "")]
    model = kneser_ney.train(docs_of(spark, rows), shards=4, order=order)
    words = lambda t: [*(t or "").lower().split(), "</s>"]
    grams = lambda t: [tuple((["<s>"] * (order - 1) + words(t))[at : at + order]) for at in range(len(words(t)))]
    raw: dict = {}
    for _, t in rows:
        for g in grams(t):
            for k in range(order):
                raw[g[k:]] = raw.get(g[k:], 0) + 1
    value = {}
    for g, c in raw.items():
        lefts = sum(h[1:] == g for h in raw if len(h) == len(g) + 1)
        value[g] = c if len(g) == order or g[0] == "<s>" else lefts
    level = lambda k: [c for g, c in value.items() if len(g) == k]
    d = {k: kneser_ney.discounts(*[sum(v == x for v in level(k)) for x in (1, 2, 3, 4)]) for k in range(1, order + 1)}
    cut = lambda k, c: (0, *d[k])[min(c, 3)]
    count = {g[0]: c for g, c in raw.items() if len(g) == 1}
    v, n = len(count), sum(count.values())

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 1 / (v + 1)
        beside = [c for h, c in value.items() if len(h) == len(g) and h[:-1] == g[:-1]]
        if not beside:
            return lower
        c = value.get(g, 0)
        return (max(c - cut(len(g), c), 0) + sum(cut(len(g), x) for x in beside) * lower) / sum(beside)

    for context in ("<s>", "a", "dd", "never"):
        assert abs(sum(p((*["<s>"] * (order - 2), context, x)) for x in [*count, "unknown"]) - 1) < 1e-9
    new = [*rows, (80, "a b never dd dd zz zz a"), (None, "c")]
    got = kneser_ney.score(docs_of(spark, new), model).collect()
    assert len(got) == len(new) and model["n"] == n and model["v"] == v
    texts = {i: t for i, t in new}
    for r in got:
        t = texts[r["doc_id"]]
        assert r["n_tokens"] == len(words(t)) and r["n_known"] == sum(x in count for x in words(t))
        assert abs(r["score"] - sum(np.log10(p(g)) for g in grams(t))) < 1e-8
        assert abs(r["base_score"] - sum(np.log10((count.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in words(t))) < 1e-8


def test_kneser_ney_packs_every_width():
    for top in (0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, 1 << 40, 1 << 62):
        x = np.array([0, top, top // 2], np.int64)
        (got, again), at = kneser_ney._unpack(b"." * 8 + kneser_ney._pack(x, x[::-1]), 2, 8)
        assert got.tolist() == x.tolist() and again.tolist() == x[::-1].tolist()


def test_kneser_ney_of_nothing(spark):
    model = kneser_ney.train(docs_of(spark, []), shards=2)
    got = kneser_ney.score(docs_of(spark, [(1, "a b")]), model).collect()[0]
    assert got["score"] == 0 and got["n_known"] == 0
    assert kneser_ney.score(docs_of(spark, []), model).count() == 0


# ------------------------------------------------------------------ op 10

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")) or kind == 3 and not 10 <= len(d) <= 15:
                continue
            if kind == 2 and not (14 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0):
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(13)
    bits = ["a@b.co", "x.y+z@q-w.e.f", "@", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "4785380592391139", "+1 (567) 555-0765", "+48 22", "é", ".", " ", "0" * 15, "a@b.c_d@e.f"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) + rng.choice(["", " ", "", "-", "."]) for _ in range(rng.randint(0, 6)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_field_spans_fit_their_kind():
    assert pii.fits("4539 1488 0343 6467", 2) and not pii.fits("1234567890123456", 2) and not pii.fits("12 34", 3) and pii.fits("(632) 555-4827", 3)
    found = pii.field_spans(["order 1234567890123456 of", "id 9999999999999999"], pii.trained())
    assert all(kind != 2 for spans in found for _, _, kind in spans)


def test_field_decoding_equals_brute_force():
    field = pii.trained()
    rng = random.Random(14)
    vocabulary = list(field.names)
    runs = [[tuple(rng.choices(vocabulary, k=8)) for _ in range(n)] for n in (1, 1, 2, 3, 3)]
    emit = lambda token: field.weights[[field.names[x] for x in token]].sum(axis=0)
    from itertools import product

    for run, got in zip(runs, field.decode(runs)):
        def total(path):
            steps = [0, *path, 0]
            return sum(field.steps[a, b] for a, b in zip(steps, steps[1:])) + sum(emit(t)[y] for t, y in zip(run, path))
        assert abs(total(got) - max(map(total, product(range(pii.LABELS), repeat=len(run))))) < 1e-6


def test_field_pruned_equals_whole_lines():
    """Lines of samples, prose and noise: what the reader prunes and shares changes no label."""
    field, rng = pii.trained(), random.Random(15)
    prose = ["the", "Über", "now,", "mail", "at", "dot", "x1", "(ok)", "A", "12:30", "weiß.", "+1", "555-0765", "a@b", "...", "[at]", "Ünïcödé", "ⅷ"]
    lines = [w for w, _ in pii.training_table(seed=5)[::3]] + [rng.choices(prose, k=rng.randint(1, 30)) for _ in range(300)]
    rng.shuffle(lines)
    firsts = np.cumsum([0, *map(len, lines)])[:-1]
    reader = pii.Reader(field)
    want = [y for path in field.decode([[pii.observations(w, k) for k in range(len(w))] for w in lines]) for y in path]
    for _ in range(2):
        assert reader.labels([w for line in lines for w in line], firsts).tolist() == want


def test_field_reads_words_without_digits():
    text = "mail john at example dot com now\nwe met at noon, dot by dot\nlook at the house"
    assert [text[b:e] for ((b, e, _),) in pii.field_spans([text], pii.trained())] == ["john at example dot com"]
    assert pii.field_spans(["", "\n\n", " "], pii.trained()) == [[], [], []]


def test_field_is_accurate_on_new_samples_and_adds_spans(spark):
    field, right, n = pii.trained(), 0, 0
    for w, labels in pii.training_table(seed=99):
        (path,) = field.decode([[pii.observations(w, k) for k in range(len(w))]])
        right += sum(x == y for x, y in zip(path, labels))
        n += len(w)
    assert right / n > 0.95
    text = "Call (632) 555-4827, mail jane(at)acme.com or a.b@c.de now"
    rows = [(1, text), (2, None), (3, ""), (3, ""), (4, "plain words only, nothing else"), (None, "1.2.3.4"), (5, "x1 " * 50_000)]
    got = {r["doc_id"]: r for r in pii.find(docs_of(spark, rows)).collect()}
    b, e = text.index("a.b@"), text.index(" now")
    assert got[1]["n_email"] == 1 and got[1]["base"] == f"email:{b}:{e}"
    spans = [(k, text[int(x) : int(y)]) for k, x, y in (s.split(":") for s in got[1]["spans"].split(","))]
    assert spans == [("phone", "(632) 555-4827"), ("email", "jane(at)acme.com"), ("email", "a.b@c.de")]
    assert got[2]["spans"] == got[3]["spans"] == got[4]["spans"] == "" and got[None]["n_ip"] == 1
    assert pii.find(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ the pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.columns == [*docs.columns, "pieces"] and 0 < len(rows) < docs.count()
    pieces = sentencepiece_viterbi.Pieces(open(sentencepiece_viterbi.default_model(), "rb").read())
    assert all(pieces.decode(np.array(r["pieces"], int)) == r["text"] and r["n_chars"] == len(r["text"]) for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)
