import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lensgraph.llm import chat_format, components, decontaminate, language_id, line_dedup, mixing, near_dedup, pitman_yor, quality_fm, quality_rules, queries, substring_dedup, textnp
from lensgraph.llm.session import id_remainder
from tests.llm import brute
from tests.llm.conftest import make

SMALL = "/root/testdata/sf0.001"


def _rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# Near duplicates


def _edited(rng, words, n, vocabulary):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = rng.choice(vocabulary)
    return " ".join(out)


def test_near_duplicates_equal_all_pairs(spark, vocabulary):
    """A hot group whose members lie on either side of the threshold, a second base close to the first, copies and loners."""
    rng = random.Random(8)
    base = [rng.choice(vocabulary) for _ in range(150)]
    second = base[:125] + [rng.choice(vocabulary) for _ in range(25)]
    texts = [_edited(rng, base, rng.randint(0, 9), vocabulary) for _ in range(90)] + [_edited(rng, second, rng.randint(0, 6), vocabulary) for _ in range(40)]
    texts += [" ".join(base)] * 5 + [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12))) for _ in range(30)]
    texts += ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g", "A  b\nc d e f g"]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    got = {r[0]: r[1:] for r in _rows(near_dedup.near_duplicates(make(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3)), "doc_id", "n_shingles", "component_id", "kept")}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute.components(rows).items()}


def test_near_duplicates_of_odd_rows(spark, odd_rows):
    got = near_dedup.near_duplicates(make(spark, odd_rows)).toPandas()
    assert len(got) == len(odd_rows)
    known = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    assert known.loc[1, "n_shingles"] == known.loc[2, "n_shingles"] == known.loc[3, "n_shingles"] == 0 and known.loc[1, "kept"]
    assert known.loc[5, "component_id"] == 4 and known.loc[6, "component_id"] == 4 and not known.loc[5, "kept"]
    assert near_dedup.near_duplicates(make(spark, odd_rows).limit(0)).count() == 0
    kept = near_dedup.keep_one_of_each(make(spark, odd_rows))
    assert kept.columns == make(spark, odd_rows).columns and 5 not in {r[0] for r in _rows(kept, "doc_id")}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(4000, 4100)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = components.components(spark.createDataFrame([*pairs, (None, 4)], "u long, v long"))
    assert sorted(_rows(found, "node", "component")) == sorted((i, root(i)) for i in list(parent))
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_roots(spark):
    """Forests with a long path, a hot root and loners."""
    up = {i: i + 1 for i in range(100)} | {i: 500 for i in range(200, 400)} | {500: 501, 600: 601}

    def root(i):
        while i in up:
            i = up[i]
        return i

    found = components.roots(spark.createDataFrame([(u, v) for v, u in up.items()], "u long, v long"))
    assert sorted(_rows(found, "node", "root")) == sorted((i, root(i)) for i in {*up, *up.values()})
    assert components.roots(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_with_a_hot_shingle(spark, vocabulary):
    """Documents of one template, below and above the threshold, that all share the template's shingles."""
    rng = random.Random(31)
    template = [rng.choice(vocabulary) for _ in range(60)]
    fill = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = [(i, " ".join(template + fill(rng.choice([2, 4, 6, 9, 12, 15, 30])))) for i in range(150)]
    got = {r[0]: r[1:] for r in _rows(near_dedup.near_duplicates(make(spark, [(i, t, "en", "a") for i, t in rows])), "doc_id", "n_shingles", "component_id")}
    assert got == brute.components(rows)


def test_documents_meet_once_for_a_run_of_shingles(spark):
    """A pair that shares one run of 40 shingles meets once, not once for each shingle and from both sides."""
    sets = spark.createDataFrame([(i, 41, [*range(40), 1000 + i]) for i in range(6)], "doc_id long, n long, shingles array<long>")
    members = spark.createDataFrame([(i, i) for i in range(6)], "doc_id long, component long")
    met = near_dedup._meetings(members, sets).collect()
    assert sorted(map(tuple, met)) == [(i, j) for i in range(6) for j in range(i + 1, 6)]


# Decontamination


def test_contamination_equals_brute_force(spark, vocabulary, odd_rows, monkeypatch):
    rng = random.Random(9)
    item = [[rng.choice(vocabulary) for _ in range(n)] for n in (10, 25, 40, 9, 3, 60)]
    items = [(i * 7, " ".join(w)) for i, w in enumerate(item)] + [(100, None), (101, "!!"), (102, " ".join(item[1])), (None, " ".join(item[2][:12]))]
    docs = [(i, t) for i, t, *_ in odd_rows if i is not None and i != 6]
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(60)]
        source = rng.choice(item)
        a = rng.randrange(len(source))
        piece = source[a : a + rng.randint(1, 14)]
        at = rng.randrange(60)
        docs.append((1000 + i, ", ".join(w[:at] + [x.upper() for x in piece] + w[at:])))
    expected = brute.contamination(docs, items)
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
        found = decontaminate.contamination(make(spark, [(i, t, "en", "a") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"))
        got = {r[0]: r[1:] for r in _rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
        for i, (n, hit, names) in expected.items():
            joined = ",".join(sorted(str(x) for x in names if x is not None))
            assert got[i] == (n, hit, len([x for x in names if x is not None]), hashlib.sha256(joined.encode()).hexdigest(), hit > 0), i


def test_contamination_of_odd_tables(spark, odd_rows):
    docs = make(spark, odd_rows)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a b c")], none.schema)).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == len(odd_rows)
    rows = [(5, "one two three four", "en", "a"), (5, "clean", "en", "a"), (None, "One, two three!", "en", "a"), (None, "clean too", "en", "a"), (7, None, "en", "a"), (5, "clean", "en", "a")]
    left = decontaminate.drop_contaminated(make(spark, rows), spark.createDataFrame([(1, "two three")], none.schema))
    assert left.columns == docs.columns and sorted(_rows(left, "doc_id", "text"), key=str) == sorted([(5, "clean"), (5, "clean"), (None, "clean too"), (7, None)], key=str)
    found = decontaminate.contamination(make(spark, rows), spark.createDataFrame([(1, "two three"), (2, "three four")], none.schema))
    assert sorted(_rows(found, "doc_id", "n_words", "n_hit", "n_items"), key=str) == sorted([(5, 4, 3, 2), (5, 1, 0, 0), (None, 3, 2, 1), (None, 2, 0, 0), (7, 0, 0, 0), (5, 1, 0, 0)], key=str)


# Line and substring dedup


def test_line_dedup_removes_later_copies_of_chunks(spark):
    rng = random.Random(3)
    line = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(5))
    shared = [line() for _ in range(12)]
    docs = [(i, "\n".join([line() for _ in range(rng.randint(1, 5))] + shared + [line() for _ in range(3)])) for i in range(20)]
    got = {r[0]: r[1:] for r in _rows(line_dedup.line_dedup(make(spark, [(i, t, "en", "a") for i, t in docs])), "doc_id", "n_chunks_removed", "n_lines_removed", "clean_text")}
    assert got[0] == (0, 0, docs[0][1])
    for i, text in docs[1:]:
        lines, left = text.split("\n"), got[i][2].split("\n")
        # Whatever went is in the shared passage, and at least its inner chunks went.
        assert [x for x in lines if x not in shared] == [x for x in left if x not in shared]
        assert got[i][1] == len(lines) - len(left) >= 4 and got[i][0] >= 1


def test_line_dedup_of_odd_rows(spark, odd_rows):
    docs = make(spark, odd_rows)
    got = line_dedup.line_dedup(docs).toPandas()
    assert len(got) == len(odd_rows) and got.clean_text.isna().sum() == 1
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
    clean = line_dedup.clean_documents(docs)
    assert clean.columns == docs.columns and clean.count() == len(odd_rows)
    twins = make(spark, [(1, "x y\nz w\nq r", "en", "a"), (2, "x y\nz w\nq r", "en", "a")])
    left = {r[0]: r[1:] for r in _rows(line_dedup.clean_documents(twins), "doc_id", "text", "n_chars")}
    assert left[1] == ("x y\nz w\nq r", 11) and all(n == len(t) for t, n in left.values())


def test_line_dedup_removes_every_repeated_run(spark):
    """Runs of two or three lines anywhere, copies of two-line documents, and lone lines that repeat, against a plain version."""
    rng = random.Random(4)
    line = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(4))
    runs, lone = [[line() for _ in range(n)] for n in (2, 2, 3, 3)], line()
    docs = [[x for part in rng.sample([*runs, [lone], [line()], [line()]], 4) for x in [*part, line()]] for _ in range(30)] + [runs[0], runs[0], ["a", "a", "a"]]
    first, gone = {}, [set() for _ in docs]
    for d, lines in enumerate(docs):
        for i, pair in enumerate(zip(lines, lines[1:], strict=False)):
            if first.setdefault(pair, (d, i)) != (d, i):
                gone[d] |= {i, i + 1}
    got = {r[0]: r[1:] for r in _rows(line_dedup.line_dedup(make(spark, [(d, "\n".join(x), "en", "a") for d, x in enumerate(docs)])), "doc_id", "n_chunks_removed", "n_lines_removed", "clean_text")}
    for d, lines in enumerate(docs):
        assert got[d] == (sum(i - 1 not in gone[d] for i in gone[d]), len(gone[d]), "\n".join(x for i, x in enumerate(lines) if i not in gone[d]))
    assert sum(got[d][2].split("\n").count(lone) for d in got) == sum(x.count(lone) for x in docs) > 1
    assert all(sum(x in got[d][2].split("\n") for d in got) == 1 for run in runs for x in run)


def _substring_equals_brute_force(spark, rows):
    docs = make(spark, [(i, t, "en", "a") for i, t in rows])
    got = _rows(substring_dedup.substring_dedup(docs.repartition(3)), "doc_id", "n_words", "n_removed_words", "removed_spans", "clean_text")
    expected = brute.substring_dedup(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, str(r[1:]))
    assert sorted(((i, n, gone, [list(s) for s in spans], clean) for i, n, gone, spans, clean in got), key=key) == sorted(((i, *expected[i, t]) for i, t in rows), key=key)
    return expected


def test_substring_dedup_equals_brute_force(spark, vocabulary, odd_rows):
    """Passages inside lines and over several, copies of short and long texts, repeats within a text, all odd rows."""
    rng = random.Random(12)
    sentence = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12))) + rng.choice(".!?")
    passage = " ".join(sentence() for _ in range(12))
    lines = "\n".join(" ".join(sentence() for _ in range(3)) for _ in range(4))
    rows = [(i, t) for i, t, *_ in odd_rows]
    for i in range(100, 140):
        own = [sentence() for _ in range(8)]
        if i % 2:
            own[4] = own[4][:-1] + " " + (passage.upper() if i == 103 else passage)
        if i % 3 == 0:
            own.insert(2, "\n" + lines + "\n")
        rows.append((i, rng.choice(["\n", " "]).join(own)))
    rows += [(200, "One"), (201, passage), (202, passage), (203, passage + " " + passage), (204, rows[-1][1]), (205, "a b.\n" * 40), (206, "x " * 30)]
    expected = _substring_equals_brute_force(spark, rows)
    by = {i: r for (i, _), r in expected.items()}
    assert by[202][3] == "" and by[200][3] == "" and by[101][1] == by[100][1] == 0 < by[103][1] and by[204][3] == ""


def test_substring_dedup_leaves_texts_without_repeats_alone(spark, vocabulary):
    """Short lines and sentences that repeat by chance stay."""
    rng = random.Random(13)
    common = [" ".join(rng.choice(vocabulary) for _ in range(n)) + "." for n in (1, 2, 3, 5, 8, 15)]
    rows = [(i, rng.choice([" ", "\n"]).join(x for _ in range(6) for x in (rng.choice(common), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(6, 15))) + "."))) for i in range(60)]
    assert all(r[1] == 0 for r in _substring_equals_brute_force(spark, rows).values())


def test_substring_dedup_of_odd_tables(spark, odd_rows):
    assert substring_dedup.substring_dedup(make(spark, odd_rows).limit(0)).count() == 0
    twins = make(spark, [(None, "a b c", "en", "a"), (None, "a b c", "en", "a"), (None, None, "en", "a"), (3, "a b c", "en", "a")])
    assert sorted(_rows(substring_dedup.substring_dedup(twins), "n_removed_words", "clean_text"), key=str) == [(0, "a b c"), (0, "a b c"), (0, None), (3, "")]


# Quality rules


def test_quality_rules_equal_brute_force(spark, odd_rows, vocabulary):
    rows = odd_rows + [(100, "a b c d e f g h " * 5, "en", "a"), (101, "x\nx\n \n \nx y", "en", "a"), (102, "é# ü* 漢<字 &" * 30, "en", "a"), (103, " ".join(vocabulary[:50]) + "\n" + "all rights reserved\n" * 3, "en", "a")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    rows = rows + [(10_000 + r[0], *r[1:]) for r in docs]
    got = _rows(quality_rules.clean_documents(make(spark, rows)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert Counter(r[:7] for r in got) == Counter((i, *brute.base_quality(t)) for i, t, *_ in rows)
    assert not any(r[6] and r[7] for r in got)
    assert quality_rules.clean_documents(make(spark, rows).limit(0)).count() == 0


def test_line_rules():
    fails = lambda s: quality_rules.line_fails(s.encode(), len(s.split()), sum(c in "#*$%&|<>" for c in s))
    assert fails("Home | About | Contact") and fails("Accueil · À propos · Contact") and fails("All rights reserved.") and fails("a &&& b$$$ c### d***") and fails("WE!! ARE!! SO!! GOOD!!")
    assert not fails("This is a sentence.") and not fails("") and not fails("A heading") and fails("w " * 45)


def test_line_rules_for_licences_menus_and_line_ends():
    fails = lambda s: quality_rules.line_fails(s.encode(), len(s.split()), sum(c in "#*$%&|<>" for c in s))
    for s in ("Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Copyright 2020 Someone.", "© 2019 A Firm", "We use cookies to serve you."):
        assert fails(s), s
    for s in ("They were released under a treaty.", "She lost her driving licence.", "The copyright lies with the author.", "The hotel room was available under another name."):
        assert not fails(s), s
    assert fails("Products / Services / Blog / Careers") and fails("Shop » Shoes » Boots » Sale")
    assert not fails("Men and / or women may apply.") and not fails("> > I agree.") and not fails("km / h")
    prose = "one two three four five six seven eight nine, ten"
    assert fails(prose) and fails(prose + ",") and not fails("one two three four five six")
    for end in (".", "!", "?", "…", ":", '."', ".”", ".)", ". \r", "。"):
        assert not fails(prose + end), end


def test_long_lines_take_linear_time():
    """A line of a million blanks, and one of a million separators."""
    for text in (b" " * 10**6 + b"home", b"| " * 10**6, b"a" * 10**6):
        assert quality_rules._measured([text], np.zeros(0, np.uint64))[0][5]


def test_quality_verdicts_equal_a_plain_version(spark, vocabulary):
    """Lines of many contexts, copies of a document, menus in lines, lost documents."""
    rng = random.Random(17)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    footer, copy = "Read More On Page 1 of 20", "\n".join(prose(12) for _ in range(3))
    rows = [(i, "\n".join([prose(15), prose(12), footer.replace("1", str(i)), prose(rng.randint(3, 20)), *(rng.choice([["Ein", "Zwei drei", "Vier", "", "Fuenf"], ["Ein", "Zwei"], []])), *(["no end " * 12] * rng.randint(0, 4))])) for i in range(40)]
    rows += [(100 + i, copy) for i in range(30)] + [(200, None), (201, ""), (202, footer)]
    fold = lambda x: re.sub("[0-9]", "0", brute.lower(x.strip()))
    filled = {i: [x for x in (t or "").split("\n") if x.strip()] for i, t in rows}
    places = {}
    for lines in filled.values():
        for j, x in enumerate(lines):
            if 3 <= len(x.split()) <= 40:
                places.setdefault(fold(x), set()).add((fold(lines[j - 1]) if j else "", fold(lines[j + 1]) if j + 1 < len(lines) else ""))
    common = {x for x, at in places.items() if len(at) >= 10}
    assert fold(footer.replace("1", "39")) in common and not {fold(x) for x in copy.split("\n")} & common
    got = {r[0]: r[1:] for r in _rows(quality_rules.clean_documents(make(spark, [(i, t, "en", "a") for i, t in rows])), "doc_id", "base_failed", "kept", "n_failed_lines", "clean_text")}
    for i, t in rows:
        lines = filled[i]
        short = ["x" if len(x.split()) <= 3 and x.rstrip()[-1] not in ".!?:;" else "-" for x in lines]
        menu = {k for m in re.finditer("x{4,}", "".join(short)) for k in range(*m.span())}
        bad = {j for j, x in enumerate(lines) if j in menu or fold(x) in common or quality_rules.line_fails(x.encode(), len(x.split()), 0)}
        chars = lambda part: sum(len(w) for x in part for w in x.split())
        kept = not got[i][0] and chars(lines[j] for j in bad) <= 0.5 * chars(lines)
        assert got[i][1:3] == (kept, len(bad)) and [x for x in (got[i][3] or "").split("\n") if x.strip()] == [x for j, x in enumerate(lines) if j not in bad], i
    assert {got[i][1] for i in range(40)} == {True, False} and got[100][2] == 0 and got[200][3] is None


# Mixing


def _one_by_one(weights, seats, limits):
    out = [0] * len(weights)
    for _ in range(min(seats, sum(int(m) for w, m in zip(weights, limits, strict=True) if w > 0))):
        i = max((i for i in range(len(out)) if out[i] < limits[i] and weights[i] > 0), key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[i] += 1
    return out


def test_apportionment_equals_one_by_one():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 8)
        w = [rng.choice([0, 1, 2, 3, rng.random() * 50]) for _ in range(n)]
        limits = [rng.randint(0, 40) for _ in range(n)]
        seats = rng.randint(0, 120)
        assert mixing.apportion(np.array(w), seats, np.array(limits)).tolist() == _one_by_one(w, seats, limits)


def test_targets():
    t = mixing.targets(np.array([100, 1000, 10]), np.array([3.0, 1.0, 2.0]), 1665.0)
    assert t.tolist() == [200.0, 1445.0, 20.0]
    assert mixing.targets(np.zeros(2), np.ones(2), 0.0).tolist() == [0, 0]


def test_mix(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 200))), "en", rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(400)]
    docs = make(spark, rows)
    got = mixing.mix(docs).toPandas()
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    whole = got.merge(pd.DataFrame({"doc_id": [r[0] for r in rows], "source": [r[3] or "~" for r in rows]}), on="doc_id")
    for _, g in whole.groupby("source"):
        assert g.source_size.iloc[0] == g["size"].sum() and abs(g.taken.sum() - g.target.iloc[0]) <= 0.03 * g.target.iloc[0] + 64


def test_mix_equals_a_plain_version(spark, odd_rows, vocabulary):
    """Word by word, on one shard a source: nulls, empty texts, repeated rows, tiny sources."""
    rng = random.Random(9)
    rows = [*odd_rows, odd_rows[3], odd_rows[3], (300, "a b c", "en", "tiny")] + [(400 + i, " ".join(rng.choice(vocabulary) for _ in range(40)), "en", "c") for i in range(60)]
    docs = make(spark, rows)
    place = {(r[0], r[1]): r[2] for r in docs.select("doc_id", "text", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text")).collect()}
    sources = sorted({r[3] for r in rows}, key=lambda x: (x is None, x or ""))
    words = [sum(len(brute.words(t)) for _, t, _, x in rows if x == name) for name in sources]
    goal = mixing.targets(np.array(words), np.array([(3.0, 1.0, 2.0)[i % 3] for i in range(len(sources))]), 1.5 * sum(words))
    block = max(16, min(256, min(w for w in words if w) // 64))
    blocks = [-(-w // block) for w in words]
    seats = _one_by_one(goal.tolist(), round(sum(goal) / block), [2 * b for b in blocks])
    turns = [r[0] for r in spark.createDataFrame([(i, 0) for i in range(len(sources))], "p int, s long").select(F.xxhash64(F.lit(mixing.SEED + 2), "p", "s")).collect()]
    expected = []
    for i, name in enumerate(sources):
        at, b = 0, max(1, blocks[i])
        more = lambda x: (x * (seats[i] % b) + turns[i] % b) // b  # noqa: B023,E731
        own = [(d, t, len(brute.words(t))) for d, t, _, x in rows if x == name]
        for d, t, n in sorted(own, key=lambda r: (place[r[0], r[1]], r[0] is not None, r[0] or 0)):
            expected.append((d, n, words[i], round(goal[i], 6), sum(seats[i] // b + more(p // block + 1) - more(p // block) for p in range(at, at + n))))
            at += n
    got = [(*r[:3], round(r[3], 6), r[4]) for r in _rows(mixing.mix(docs), "doc_id", "size", "source_size", "target", "taken")]
    assert sorted(got, key=str) == sorted(expected, key=str)
    for i, name in enumerate(sources):
        assert abs(seats[i] * block - goal[i]) <= 2 * block


def test_mix_of_odd_rows(spark, odd_rows):
    assert mixing.mix(make(spark, odd_rows)).count() == len(odd_rows)
    assert mixing.mix(make(spark, odd_rows).limit(0)).count() == 0
    assert {r[0] for r in _rows(mixing.mix(make(spark, [(1, None, "en", "a"), (2, "", "en", None)])), "taken")} == {0}


# Language model


def _tokens(text):
    return [*brute.words(text), "\n"]


def test_base_scores_equal_brute_force(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BATCH_BYTES", 40_000)
    rows = odd_rows
    got = pitman_yor.score(make(spark, rows), pitman_yor.learnable()).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in _tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        own = _tokens(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(own), sum(w in counts for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert r["score"] < 0
    assert pitman_yor.score(make(spark, rows).limit(0), pitman_yor.learnable()).count() == 0


def _totals(own):
    """Totals of one partition that is the whole corpus, through the sweeps."""
    by = lambda x: np.bincount(own.context, x, minlength=pitman_yor.CONTEXTS).astype(float)
    totals = pitman_yor.Totals(int(own.counts.sum()), len(own.words), 0.6, 0.4, by(own.counts))
    for s in range(pitman_yor.BURN_IN + pitman_yor.SAMPLES + 1):
        *_, (tables, guests, upper, _) = own.chain(totals, s)
        totals = pitman_yor.Totals(totals.tokens, totals.words, 0.6, 0.4, totals.customers, (*totals.sweeps, (by(tables), float(guests.sum()), float(upper.sum()))))
    return totals


def test_predictive_probabilities_sum_to_one(vocabulary):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(vocabulary[: 5 * rng.randint(1, 40)]) for _ in range(rng.randint(0, 90))).encode() for _ in range(60)]
    keys = np.concatenate([pitman_yor.token_keys(texts)[0]])
    unique, counts = np.unique(keys, return_counts=True)
    own = pitman_yor.Sections(0, pitman_yor.pack(unique, counts))
    predict = pitman_yor.Predictive(own, _totals(own))
    unknown = np.uint64(0xABCDEF00) << np.uint64(16)
    for context in [0, *np.unique(own.context)[:40], 65535]:
        p, _ = predict(np.sort(np.append(own.words, unknown) | np.uint64(context)))
        assert p.sum() == pytest.approx(1.0) and (p > 0).all()


def test_seating_follows_the_restaurant():
    """The mean number of tables of many seatings against the exact recursion."""
    n, d, pull = 12, 0.5, 0.7
    dist = {1: 1.0}
    for seated in range(1, n):
        nxt = Counter()
        for t, p in dist.items():
            new = pull / (pull + seated - d * t)
            nxt[t + 1] += p * new
            nxt[t] += p * (1 - new)
        dist = nxt
    got = pitman_yor.seat(np.random.default_rng(1), np.full(40_000, n), np.full(40_000, pull), d)
    assert got.mean() == pytest.approx(sum(t * p for t, p in dist.items()), rel=0.02)
    assert pitman_yor.seat(np.random.default_rng(1), np.array([0, 1, 10**6]), np.full(3, 0.5), d)[:2].tolist() == [0, 1]


def test_packing(vocabulary):
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        counts = rng.integers(0, 1 << 31, len(keys))
        back = pitman_yor.unpack(pitman_yor.pack(keys, counts))
        assert (back[0] == keys).all() and (back[1] == counts).all()


def test_texts_that_occur_twice_score_apart(spark, vocabulary):
    """Word pairs seen elsewhere raise a text's score beyond what its words alone do."""
    rng = random.Random(23)
    text = lambda: " ".join(rng.choice(vocabulary[:800]) for _ in range(80))
    once, twice = [text() for _ in range(40)], [text() for _ in range(10)]
    rows = [(i, t, "en", "a") for i, t in enumerate(once + twice + twice)]
    got = {r["doc_id"]: (r["score"] - r["base_score"]) / r["n_tokens"] for r in pitman_yor.score(make(spark, rows), F.lit(True)).collect()}
    assert min(got[i] for i in range(40, 60)) > max(got[i] for i in range(40))


def test_one_id_is_many_batches(spark, vocabulary, monkeypatch):
    """Null ids and one repeated id, over many batches, against all in one."""
    rng = random.Random(29)
    rows = [(rng.choice([None, 7]), " ".join(rng.choice(vocabulary) for _ in range(60)), "en", "a") for _ in range(60)]
    seen = {}
    for size in (2_000, 1 << 30):
        monkeypatch.setattr(pitman_yor, "BATCH_BYTES", size)
        found = pitman_yor.score(make(spark, rows), pitman_yor.learnable())
        seen[size] = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found.collect())
    assert seen[2_000] == seen[1 << 30] and len(seen[2_000]) == 60


def test_model_beats_the_base_on_held_out_texts(spark):
    got = queries.op7_lm_scoring(spark, SMALL).toPandas()
    assert got.score.sum() > got.base_score.sum() and got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


# Models


def test_language_accuracy_on_held_out_texts(spark):
    got = queries.op2_language_id(spark, SMALL).toPandas()
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(truth) and (held.lang == held.lang_pred).mean() > 0.95 and both.score.between(0, 1).all()


def test_language_of_odd_rows(spark, odd_rows):
    docs = make(spark, odd_rows)
    model = language_id.train(docs, id_remainder("doc_id", 4) != 2)
    got = language_id.identify(docs, model).toPandas()
    by = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    assert len(got) == len(odd_rows)
    assert {i for i in by.index if by.loc[i, "lang_pred"] == "und"} == {1, 2, 3, 9} and by.loc[10, "lang_pred"] in {"de", "en", "fr"}
    nothing = language_id.train(docs.limit(0), id_remainder("doc_id", 4) != 2)
    assert nothing is None and set(language_id.identify(docs, nothing).toPandas().lang_pred) == {"und"}
    kept = language_id.drop_unknown(docs)
    assert kept.columns == docs.columns and not {1, 2, 3, 9} & {r[0] for r in _rows(kept, "doc_id")}


def test_every_language_is_learned(spark, vocabulary, monkeypatch):
    """230 languages of one row, and one of many; too many for a model are an error."""
    rows = [(i, f"{vocabulary[i]} {vocabulary[i + 500]}", f"l{i:03d}", "a") for i in range(230)] + [(1000 + i, " ".join(vocabulary[i : i + 9]), "en", "a") for i in range(200)]
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 400, raising=False)
    assert set(language_id.train(make(spark, rows), id_remainder("doc_id", 4) < 4).langs) == {r[2] for r in rows}
    monkeypatch.setattr(language_id, "MAX_LANGS", 230)
    with pytest.raises(ValueError, match="more than 230 languages"):
        language_id.train(make(spark, rows), id_remainder("doc_id", 4) < 4)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_quality_classifier(spark, sf).toPandas()
    both = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.9 and got.score.between(0, 1).all()


def test_factorisation_machine_identity():
    rng = np.random.default_rng(3)
    model = quality_fm.Model(0.3, rng.standard_normal(50).astype(np.float32), rng.standard_normal((50, 8)).astype(np.float32))
    index, value = np.array([3, 7, 9, 40]), np.array([0.5, 2.0, -1.0, 0.25], dtype=np.float32)
    direct = 0.3 + value @ model.weights[index] + sum(value[i] * value[j] * (model.factors[index[i]] @ model.factors[index[j]]) for i in range(4) for j in range(i))
    assert model.raw(index, value) == pytest.approx(float(direct), rel=1e-4)


def test_quality_of_odd_rows(spark, odd_rows):
    docs = make(spark, odd_rows)
    labels = spark.createDataFrame([(4, 1, 0), (8, 0, 0), (20, 1, None), (21, None, 0), (None, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = quality_fm.quality(docs, quality_fm.train(docs, some, id_remainder("doc_id", 4) != 2)).toPandas()
        assert len(got) == len(odd_rows) and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()


# Chat


LOG = "conv_id long, turn long, kind string, role string, text string, target int"


def test_events_fold(spark):
    log = [
        (1, 0, "message", "user", "hi", None),
        (1, 1, "delta", "assistant", "He", None),
        (1, 2, "delta", "assistant", "llo", None),
        (1, 3, "regenerate", None, None, None),
        (1, 4, "message", "assistant", "Good day </s>", None),
        (1, 5, "message", "user", "bye", None),
        (1, 6, "edit", None, "wait", 2),
        (2, 0, "message", None, None, None),
        (None, 0, "message", "user", "x", None),
    ]
    text = {r[0]: r[1] for r in _rows(chat_format.formatted(spark.createDataFrame(log, LOG)), "conv_id", "formatted")}
    assert [t[:2] for t in chat_format.read_back(text[1])] == [("user", "hi"), ("assistant", "Good day </s>"), ("user", "wait")]
    assert [t[:2] for t in chat_format.read_back(text[2])] == [("user", "")] and len(text) == 3
    digest = {r[0]: r[1] for r in _rows(chat_format.digests(spark.createDataFrame(log, LOG)), "conv_id", "n_turns")}
    assert digest == {1: 3, 2: 1, None: 1}
    assert chat_format.digests(spark.createDataFrame([], LOG)).count() == 0
    with pytest.raises(ValueError):
        list(chat_format.fold([("edit", "user", "x", 3)]))


def test_chat_round_trip():
    rng = random.Random(1)
    pieces = [*chat_format.CONTROL, "\\", "a", " ", "\n", "<", ">", "[", "]", "/", "é", "INST"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "a>>b", "x\\"]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))) for _ in range(rng.randint(0, 4))]
        out = chat_format.render(turns)
        back = list(chat_format.read_back(out))
        assert [t[:2] for t in back] == turns
        assert all(chat_format.unescape(out[m[0] : m[1]]) == text for _, text, m in back if m)


def _equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    rel = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    order = [rel.columns.index(c) for c in columns]
    assert Counter(str([r[c] for c in columns]) for r in df.collect()) == Counter(str([r[i] for i in order]) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    _equals_sql(spark, name)


def test_control_conversation(spark):
    row = {r["conv_id"]: r for r in queries.op9_chat_format(spark, SMALL).collect()}[-7]
    same = "</s>[INST] ok [/INST]"
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(same), hashlib.sha256(same.encode()).hexdigest())
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{same}\nassistant\n{same}\n".encode()).hexdigest()


def test_words_and_shingles(odd_rows):
    texts = [None if r[1] is None else r[1].encode() for r in odd_rows]
    words = textnp.Words(texts)
    assert np.diff(words.bounds).tolist() == [len(brute.words(r[1])) for r in odd_rows]
    named = {}
    for i, r in enumerate(odd_rows):
        for h, w in zip(words.hashes[words.bounds[i] : words.bounds[i + 1]].tolist(), brute.words(r[1]), strict=True):
            assert named.setdefault(h, w) == w
    assert len(named) == len(set(named.values()))


def test_formatted_conversations_read_back_as_their_digests(spark):
    """The whole texts of a fixture and of the control conversation, with their loss spans, against the query."""
    log = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    log = log.unionByName(spark.createDataFrame(chat_format.CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string"))
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    got = set()
    for conv, text, spans in _rows(chat_format.formatted(log), "conv_id", "formatted", "loss_spans"):
        turns = list(chat_format.read_back(text))
        assert [list(m) for _, _, m in turns if m] == [list(s) for s in spans]
        masked = "".join(chat_format.unescape(text[a:b]) for a, b in spans)
        got.add((conv, len(turns), sha("".join(f"{r}\n{x}\n" for r, x, _ in turns)), len(masked), sha(masked), len(text)))
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert got == set(_rows(queries.op9_chat_format(spark, SMALL), *names)) and -7 in {r[0] for r in got} and len(got) > 1
