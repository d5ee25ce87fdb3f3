"""Near-duplicates, substrings, lines, decontamination: against comparisons of everything with everything."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from cartoledger.llm import decontaminate, linededup, simhash, substrings
from cartoledger.llm.components import components
from tests.llm import helpers

SF = "/root/testdata/sf0.001"
DRAW = random.Random(11)


def _sentence(n, kinds=400):
    return " ".join(f"w{DRAW.randrange(kinds)}" for _ in range(n))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (201, 200), (200, 201)]
    links = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}
    assert got == want
    assert components(links.limit(0)).count() == 0


def test_byte_groups_cover_every_choice():
    for shared in range(1, 9):
        groups = simhash.byte_groups(shared, min(4, shared))
        assert all(any(set(g) <= set(c) for g in groups) for c in itertools.combinations(range(8), shared))


@pytest.mark.parametrize("pair_list", [512, 1])
def test_links_find_all_near_fingerprints(spark, pair_list):
    """Random fingerprints, chains of flipped bits and tight clusters; long index lists by shared neighbour points."""
    draw = random.Random(5)
    fps = {draw.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:12]:
        for _ in range(8):
            base ^= sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 6)))
            fps.add(base)
    cluster = draw.getrandbits(64)
    fps |= {cluster ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(4))) for _ in range(40)}
    fps = sorted(fps)
    table = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.links(table, 3, pair_list)).collect()}
    want = helpers.near_groups(fps)
    groups = {}
    for f, g in zip(fps, want):
        groups.setdefault(g, []).append(_signed(f))
    for members in groups.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_near_duplicates_equal_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    extra = [(10_000 + i, t + " tail") for i, (_, t) in enumerate(rows[:40])] + [(20_000, ""), (20_001, None), (20_002, "AB")]
    rows += extra
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [helpers.simhash(t) for _, t in rows]
    want = helpers.near_groups(fps)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    for (i, _), f, g in zip(rows, fps, want):
        assert got[i]["fp"] == _signed(f) and got[i]["component_id"] == rows[g][0]
    kept = {r["doc_id"] for r in simhash.keep_first(docs).collect()}
    assert kept == {rows[g][0] for g in want}


def test_near_duplicates_awkward_rows(spark):
    docs = helpers.awkward(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["fp"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (2, 3)").count() == 0
    assert kept.where("doc_id = 4").count() == 2  # repeated rows are one document


@pytest.mark.parametrize("hot_seed", [200_000, 1])
def test_substrings_equal_plain_version(spark, hot_seed):
    passages = [_sentence(n) for n in (13, 14, 20, 55, 80)]
    texts = [_sentence(DRAW.randrange(5, 60), 3000) for _ in range(30)]
    for _ in range(60):
        parts = [_sentence(DRAW.randrange(0, 20), 3000), DRAW.choice(passages), _sentence(DRAW.randrange(0, 20), 3000)]
        if DRAW.random() < 0.3:
            parts.append(" ".join(DRAW.choice(passages).split()[: DRAW.randrange(12, 15)]))
        texts.append(" ".join(parts))
    texts += [texts[3]] * 5 + ["a " * 60, "a " * 40, "b"]
    docs = helpers.table(spark, texts)
    want = helpers.repeats(list(enumerate(texts)), 13)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs, 13, hot_seed=hot_seed).collect()}
    assert len(got) == len(texts)
    for i, (ws, gone) in want.items():
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        r = got[i]
        assert (r["n_words"], r["n_removed"]) == (len(ws), sum(gone))
        assert bytes(r["kept"]).decode() == kept and r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        assert sum(s["end"] - s["start"] for s in r["spans"]) == sum(gone)


@pytest.mark.parametrize("n", [1, 3, 5, 6])
def test_substrings_short_windows(spark, n):
    texts = ["a b c d e f g", "x a b c d e f y", "c d", "a b c", "g f e d c b a"]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(helpers.table(spark, texts), n).collect()}
    assert got == {i: sum(g) for i, (_, g) in helpers.repeats(list(enumerate(texts)), n).items()}


def test_substrings_awkward_rows(spark):
    run = " ".join(f"q{i}" for i in range(20))
    docs = helpers.awkward(spark, [(8, run), (9, run), (None, run), (8, "other text")])
    rows = substrings.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    removed = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in rows}
    assert removed[9, 20] == 20 and removed[8, 20] == 0 and removed[None, 20] == 0 and removed[4, 4] == 0
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_lines_equal_plain_version(spark):
    base = [_sentence(n, 60) for n in (1, 2, 3, 4, 5, 6, 9, 12, 20, 33)] * 2
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(DRAW.randrange(0, 7)):
            ws = DRAW.choice(base).split()
            for _ in range(DRAW.randrange(0, 4)):
                ws[DRAW.randrange(len(ws))] = f"w{DRAW.randrange(60)}"
            lines.append(DRAW.choice([" ", "  ", "\t"]).join(ws) if DRAW.random() < 0.9 else "")
        texts.append("\n".join(lines))
    docs = helpers.table(spark, texts)
    want = helpers.dedup_lines(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert sum(r["n_removed"] for r in got.values()) > 50
    assert all(r["n_lines"] == sum(bool(helpers.words(x)) for x in texts[i].split("\n")) for i, r in got.items())


def test_lines_other_thresholds(spark):
    texts = ["\n".join(" ".join(DRAW.sample("abcdefgh", DRAW.randrange(1, 7))) for _ in range(4)) for _ in range(20)]
    for num, den in ((1, 2), (1, 1), (9, 10)):
        got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(helpers.table(spark, texts), (num, den)).collect()}
        assert got == helpers.dedup_lines(list(enumerate(texts)), num, den)


def test_lines_awkward_rows(spark):
    docs = helpers.awkward(spark, [(8, "same row twice here\nnew words only"), (None, "same row twice here")])
    rows = linededup.dedup_lines(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["text"] for r in by[8]] == ["new words only"] and [r["text"] for r in by[4]] == ["same row twice here"] * 2
    assert by[1][0]["text"] is None and by[2][0]["text"] == "" and by[3][0]["text"] == " \n\t \n"
    assert sorted(r["n_removed"] for r in by[None]) == [0, 0, 0]
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_a_family_of_common_words_meet_their_leader(spark):
    draw = random.Random(5)
    kinds = [f"c{i}" for i in range(200)]
    texts = [" ".join(draw.sample(kinds, 20)) for _ in range(200)]
    base = draw.sample(kinds, 40)
    family = [" ".join(draw.sample(base, 38)) for _ in range(40)]
    docs = helpers.table(spark, texts + family).select("doc_id", "text")
    sets = linededup._sets(docs, linededup.frequency_classes(docs), 4, 5)
    pairs = linededup._leader_pairs(sets, 4, 5).where("a_doc_id >= 200")
    assert pairs.select("b_doc_id").distinct().count() >= 30
    assert {r[0] for r in pairs.select("b_doc_id").collect()} <= set(range(201, 240))


def test_lines_only_those_of_pairs_are_shuffled_to_verify(spark):
    texts = [f"a{i} b{i} c{i} d{i} e{i}\n" + " ".join(f"x{i}y{j}" for j in range(200)) for i in range(50)]
    docs = helpers.table(spark, [*texts, "a0 b0 c0 d0 e0 f0"])
    pairs = spark.createDataFrame([(0, 0, 50, 0), (1, 0, 50, 0)], "a_doc_id long, a_line_no int, b_doc_id long, b_line_no int")
    found = linededup._verified(pairs, docs, 4, 5)
    assert [tuple(r) for r in found.collect()] == [(50, 0)]
    marked = spark.createDataFrame([(7, 3), (7, 3), (8, -1), (None, 2)], "doc_id long, line_no int")
    assert sum(bin(r["bits"] & (1 << 64) - 1).count("1") for r in linededup._marks(marked).collect()) == 3


def test_lines_equal_sets_meet_by_hash_at_their_first_place(spark):
    """No sort of whole sets to group them; ids of any sign and size keep their order and come back."""
    ids = [-(2**63), -5, -4, 7, 2**63 - 1]
    rows = [(i, f"only{k}\nthe same words here\nhere\twords  same the") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    sets = linededup._sets(docs, linededup.frequency_classes(docs), 4, 5)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert {(r["doc_id"], r["line_no"], r["n"]) for r in sets.collect()} == {(i, 0, 1) for i in ids} | {(-(2**63), 1, 4)}
    got = {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(docs).collect()}
    assert got == {i: 1 if i == -(2**63) else 2 for i in ids}


def test_lines_of_a_family_unlike_its_first_member_settle_early(spark):
    """Most members resemble some others but not the first; few of them are left to meet the whole family."""
    draw = random.Random(11)
    base = [f"k{i}" for i in range(60)]
    texts = []
    for m in range(300):
        ws = list(base)
        for at in draw.sample(range(60), 6 if m == 0 else m % 6):
            ws[at] = f"m{m}at{at}"
        texts.append(" ".join(ws))
    docs = helpers.table(spark, texts).select("doc_id", "text")
    sets = linededup._sets(docs, linededup.frequency_classes(docs), 4, 5).cache()
    pairs = linededup._leader_pairs(sets, 4, 5)
    assert pairs.count() == pairs.select("b_doc_id").distinct().count()
    early = linededup._verified(pairs, docs, 4, 5).withColumn("done", F.lit(True))
    marked = sets.join(early, ["doc_id", "line_no"], "left").fillna(False, ["done"])
    assert early.count() >= 200
    assert linededup._candidates(marked, 4, 5).count() <= 3000
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    assert got == helpers.dedup_lines(list(enumerate(texts)))


def test_lines_native_plan(spark):
    plan = linededup.dedup_lines(helpers.table(spark, ["a b", "c d"]))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def _benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_decontamination_equals_plain_version(spark, block_words):
    items = [(i, _sentence(DRAW.randrange(15, 60), 900)) for i in range(12)] + [(20, "three word item"), (21, None), (22, ""), (None, "no id")]
    texts = []
    for _ in range(70):
        ws = DRAW.choice(items[:12])[1].split()
        for _ in range(DRAW.randrange(0, 4)):
            at = DRAW.randrange(len(ws))
            if DRAW.random() < 0.5:
                ws[at] = "changed"
            elif DRAW.random() < 0.5:
                ws.insert(at, "added")
            else:
                del ws[at]
        texts.append(" ".join([_sentence(DRAW.randrange(30), 900), " ".join(ws).upper(), _sentence(DRAW.randrange(30), 900)]))
    texts += [_sentence(80, 900) for _ in range(20)] + ["a Three word\nitem here", "three word", items[0][1] + " " + items[1][1]]
    docs = helpers.table(spark, texts)
    got = {}
    found = decontaminate.contaminated(docs, _benchmark(spark, items), block_words=block_words)
    for r in found.collect():
        assert r["item_id"] not in got.setdefault(r["doc_id"], {})
        got[r["doc_id"]][r["item_id"]] = r["similarity"]
    usable = [(i, t) for i, t in items if i is not None and t]
    want = {d: m for d, t in enumerate(texts) if (m := helpers.leaks(t, usable))}
    assert got == want and len(want) > 15
    kept = decontaminate.drop_contaminated(docs, _benchmark(spark, items), block_words=block_words)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - set(want) and kept.schema == docs.schema


def test_decontamination_awkward_rows(spark):
    docs = helpers.awkward(spark, [(8, "x same row twice here x")])
    bench = _benchmark(spark, [(1, "same row twice here"), (2, "same row twice here")])
    rows = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(4, 1), (4, 1), (4, 2), (4, 2), (8, 1), (8, 2)]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.drop_contaminated(docs, bench).where(F.col("doc_id") == 4).count() == 0


def test_items_longer_than_the_document(spark):
    """Whole items with words cut off at an end or deleted are found like longer documents; others are not."""
    items = [(i, " ".join(f"q{i}x{j}" for j in range(n))) for i, n in enumerate((3, 5, 15, 20, 40, 50, 59))]
    cuts = (lambda w: w[:-1], lambda w: w[1:], lambda w: w[1:-1], lambda w: w[:-2], lambda w: w[:9] + w[10:], lambda w: w[:25] + w[26:], lambda w: w[: len(w) // 2])
    texts = [" ".join(cut(t.upper().split())) for _, t in items for cut in cuts]
    docs = helpers.table(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    want = {(i, item): s for i, t in enumerate(texts) for item, s in (helpers.leaks(t, items) | helpers.short_leaks(t, items)).items()}
    assert len(want) >= 15 and got == pytest.approx(want)
    assert all((r["start_word"], r["n_words"]) == (0, len(texts[r["doc_id"]].split())) for r in found)
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}


def test_keep_first_with_repeated_and_null_ids(spark):
    """Every component keeps one document, whatever ids repeat or are null; rows equal in all columns are one."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a, "s1"), (2, a, "s2"), (2, b, "s3"), (None, c, "s4"), (None, c, "s5"), (None, c, "s4"), (3, d, "s6"), (3, d, "s6")]
    rows += [(4, b, "s7"), (None, a, "s8"), (5, None, "s9"), (6, "", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(tuple(r) for r in simhash.keep_first(docs).select("text", "doc_id").fillna("-", "text").collect())
    assert [g for g in got if g[0] != c] == sorted([("-", 5), (a, 1), (b, 2), (d, 3), (d, 3)])
    assert 1 <= sum(g[0] == c for g in got) <= 2 and all(g[1] is None for g in got if g[0] == c)
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema and simhash.keep_first(docs.limit(0)).count() == 0


def test_line_dedup_carries_columns(spark):
    rows = [(None, "x y", "en", "a"), (None, "x y", "de", "b"), (1, "p q\nr s", "fr", "c"), (1, "p q\nr s", "es", "d"), (2, None, "en", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = linededup.dedup_lines(docs, carry=("lang", "source"))
    assert sorted(r["source"] + r["lang"] for r in out.collect()) == ["aen", "bde", "cfr", "des", "een"]
