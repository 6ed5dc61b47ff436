"""Language identification, license scan, mixing, the pipeline and the registered queries."""

import math
import re
import shutil
import subprocess
import sys
import textwrap
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from laminar.llm import langid, licenses, queries
from laminar.llm.common import table, word_count
from laminar.llm.licenses import Templates, scan_licenses, terms_of
from laminar.llm.mixing import mix
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.conftest import EDGE
from tests.llm.test_jaccard import brute
from tests.parity import compare, duck


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, key):
    got = compare(spark, SF_CHECK, key, queries.QUERIES[key], queries.ORACLE[key], duck(SF_CHECK))
    assert got["status"] == "match", got


def test_all_operators_and_the_pipeline_are_registered():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_the_library_does_not_need_this_subpackage():
    root = Path(entry.__file__).parent
    used = [p for p in (root / "laminar").rglob("*.py") if "llm" not in p.parts and "laminar.llm" in p.read_text()]
    assert not used


def test_a_copy_without_the_text_folders_works(tmp_path):
    root, copy = Path(entry.__file__).parent, tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache", "*.json", "*.txt"))
    assert not list(copy.rglob("llm"))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 50 and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=copy)
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_api.py", "tests/test_dedup_upsert_checks.py"], check=True, cwd=copy)


# ---- language identification ----

def plain_bits(grams, word, order):
    """Code length of one word by the definition, from counts of (context, next byte)."""
    total = 0.0
    text = b" " + word + b" "
    for i in range(1, len(text)):
        for k in range(min(i, order), -1, -1):
            seen = grams.get(text[i - k: i], {})
            if not seen:
                continue
            n = sum(seen.values()) + len(seen)
            if text[i] in seen:
                total -= math.log2(seen[text[i]] / n)
                break
            total -= math.log2(len(seen) / n)
        else:
            total += 8
    return total


def test_code_lengths_equal_the_definition():
    texts, order = ["The cat sat on the mat.", "a cat, and THE hat äö"], 3
    grams = defaultdict(Counter)
    for t in texts:
        for w in t.lower().encode().split():
            s = b" " + w + b" "
            for i in range(1, len(s)):
                for k in range(min(i, order) + 1):
                    grams[s[i - k: i]][s[i]] += 1
    trees = {"x": langid.Trees(*langid.count_grams(texts, order))}
    scorer = langid.Scorer(trees, order)
    for probe in ["the cat", "zebra", "ÄÖ hat hats", "a", "", "q" * 300]:
        want = sum(plain_bits(grams, w, order) for w in probe.lower().encode().split())
        assert scorer.texts([probe])[0][0] == pytest.approx(want)


def test_language_of_held_out_documents(spark):
    rows = queries.op6_language_id(spark, SF_CHECK).join(table(spark, SF_CHECK, "documents"), "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert len(held) > 250 and np.mean(held) >= 0.98


def test_language_edge_rows(spark, edge, nothing):
    trees = langid.fit(edge)
    got = langid.predict(edge, trees).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _, _ in EDGE)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 4}
    kept = langid.predict(edge, trees, carry=True)
    assert kept.columns == [c for c in edge.columns if c != "score"] + ["lang_pred", "score"]
    assert langid.predict(nothing, trees).count() == 0 and langid.fit(nothing) == {}
    assert {r.lang_pred for r in langid.predict(edge, {}).collect()} == {"und"}


def test_scores_do_not_depend_on_the_known_words():
    trees = {"x": langid.Trees(*langid.count_grams(["one two three four"], 4))}
    wide, narrow = langid.Scorer(trees, 4), langid.Scorer(trees, 4, limit=2)
    texts = ["one two", "three one four", "five six seven", ""]
    assert np.allclose(wide.texts(texts), narrow.texts(texts))


# ---- license scan ----

def brute_units(path, text):
    """Units of a file by level: whole licence files, blocks of several lines, lines."""
    lines = text.split("\n")
    runs, sign = [], r"[ \t]*(#|\*|;|%|//|--|/\*|<!--)"
    for pattern in (sign, sign + ".*[A-Za-z0-9]"):
        run = []
        for line in [*lines, ""]:
            if re.match(pattern, line):
                run.append(line)
            else:
                runs, run = [*runs, "\n".join(run)], []
    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    units = [(2, x) for x in lines] + [(1, x) for x in [*paragraphs, *runs] if re.search(r"[^ \t\r\n][^\n]*\n[^\n]*[^ \t\r\n]", x)]
    if path is not None and re.match(r"(license|licence|copying|notice)(\.[^/]*)?$", path.split("/")[-1].lower()):
        units.append((0, text))
    return [(level, x) for level, x in units if re.search(licenses.KEYWORDS, x)]


def brute_licenses(rows, threshold=0.8):
    known = Templates()
    own = {}
    for path, text in rows:
        best = None
        for level, u in [] if text is None else brute_units(path, text):
            bag = {t: n * known.idf.get(t, known.other) for t, n in Counter(terms_of(u)).items()}
            size = math.sqrt(sum(w * w for w in bag.values()))
            for i, (t, norm) in enumerate(zip(known.weights, known.norms)):
                s = round(sum(w * t.get(x, 0) for x, w in bag.items()) / size / norm, 9) if size else 0
                if s >= threshold and (best is None or (-level, s, -i) > best[0]):
                    best = ((-level, s, -i), known.names[i])
        own[path, text] = best and best[1]
    return own


def wrapped(text, mark="", width=70):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_headers_and_licence_files_are_told(spark):
    """Wrapped headers, SPDX lines and whole licence files, as they stand in real trees."""
    copyright_ = "Copyright (c) 2021, Some Body <some@body.example>\n"
    header, body, title = ([(n, t) for n, t in group] for group in (licenses.HEADERS, licenses.BODIES, licenses.TITLES))
    rows = []
    for i, (name, text) in enumerate(header):
        rows.append((name, f"h/{i}.py", f"#!/usr/bin/env python\n{wrapped('Copyright 2020 The Authors.', '# ')}\n#\n{wrapped(text, '# ')}\nimport os\n\nx = 1\n"))
        rows.append((name, f"h/{i}.c", f"/*\n * Copyright 2019 Foo Inc.\n *\n{wrapped(text, ' * ', 60)}\n */\n\nint main(void);\n"))
    for i, (name, text) in enumerate(body):
        words = text.replace("(c)", "(c) 2018 Some Body", 1)
        rows.append((name, f"b/{i}/LICENSE", wrapped(words, "", 78)))
        rows.append((name, f"b/{i}/LICENSE.txt", copyright_ + "All rights reserved.\n\n" + wrapped(text)))
    long_text = "\n\n".join(f"{n}. Definitions and terms of section {n}.\n" + wrapped("words of a long section " * 40) for n in range(30))
    for i, (name, text) in enumerate(title):
        if name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0") and " " in text and "ersion" in text:
            first, _, rest = text.partition(" Version")
            rows.append((name, f"t/{i}/COPYING", f"          {first}\n             Version{rest}\n\n{long_text}"))
    rows += [(x, f"s/{x}.js", f"// SPDX-License-Identifier: {x}\nlet a = 1;\n") for x in licenses.SPDX]
    rows += [("proprietary", "p/a.c", "// All rights reserved.\nint a;\n"), (None, "n/a.txt", "permission to land was granted\nby the tower, free of charge"),
             (None, "n/b.txt", "// SPDX-License-Identifier: Unheard-Of-1.0"), (None, "n/c.txt", long_text)]
    df = spark.createDataFrame([(i, p, t) for i, (_, p, t) in enumerate(rows)], "doc_id long, path string, text string").repartition(4)
    got = {r.path: r.license for r in scan_licenses(df).where("origin <> 'inherited'").collect()}
    assert {p: got[p] for _, p, _ in rows} == {p: n for n, p, _ in rows}


def test_license_scan(spark):
    rows = [("r/LICENSE", "MIT License\nReleased under the MIT License."), ("r/a/x.py", "code\n"), ("r/a/COPYING.txt", "Licensed under CC BY-NC 4.0."),
            ("r/a/b/y.py", "x = 1"), ("r/a/b/z.py", "# All rights reserved.\n"), ("q/y.py", "plain"), ("q/LICENSE", None), ("", "nothing"),
            (None, "Licensed under the Apache License, Version 2.0."), ("r/a/b/y.py", "x = 1"), ("q/d/NOTICE", "words " * 3000),
            ("s/f", "by the public version of this work, cc"), ("s/g", "license"), ("s/h", "Licensed under the GNU General Public License version 3")]
    df = spark.createDataFrame([(i, p, t, "clash", "clash") for i, (p, t) in enumerate(rows)],
                               "doc_id long, path string, text string, license string, score string")
    got = {r.doc_id: r for r in scan_licenses(df).collect()}
    own = brute_licenses(rows)
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        assert (got[i].license if got[i].origin == "own" else None) == own[row], row
    assert (got[1].license, got[1].origin, got[1].from_dir) == ("CC-BY-NC-4.0", "inherited", "r/a")
    assert (got[3].license, got[3].origin) == ("CC-BY-NC-4.0", "inherited") and got[9].license == got[3].license
    assert got[4].license == "proprietary" and got[5].origin == "none" and got[7].origin == "none"
    assert scan_licenses(df.limit(0)).count() == 0


# ---- mixing ----

def brute_targets(sizes, weights=(3, 1, 2)):
    """The shares by the contract: give by weight, cap, and share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            out.update(share)
            break
        out.update({s: 2.0 * sizes[s] for s in over})
        open_ -= over
    return out


def check_mix(rows):
    sizes, most, taken = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        most[r.source] = max(most[r.source], r.size)
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 2
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert abs(taken[s] - t) <= most[s] + 1e-6, (s, taken[s], t)


def test_mix_meets_its_targets(spark):
    docs = table(spark, SF_CHECK, "documents").withColumn("id", F.col("doc_id"))
    first = mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(first) == 1000
    check_mix(first)
    again = mix(docs.repartition(5)).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    for source in {r.source for r in first}:  # rates are exponential in the size, up to the cap
        inner = [(r.size, math.log(r.rate)) for r in first if r.source == source and 0 < r.rate < 1.999 and r.size]
        if len(inner) > 2:
            slope = [y / x for x, y in inner]
            assert max(slope) - min(slope) < 1e-6


def test_mix_edge_rows(spark, edge, nothing):
    got = mix(edge)
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in EDGE]
    assert Counter((r.doc_id, r.size) for r in got.collect()) == Counter(zip([i for i, _, _, _ in EDGE], words))
    assert mix(nothing).count() == 0
    assert all(r.copies == 0 for r in mix(edge.where("doc_id < 4")).collect())


def test_word_count(spark):
    texts = ["", " ", "a", " a", "a ", "\x0ba\x0c\x1cb\xa0c d\n\n", None, "ä\tö"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", word_count(F.col("t")).alias("n")).collect()
    assert all(r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.t or "")) for r in got)


# ---- pipeline ----

def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    odd = spark.createDataFrame([(100000, None, "en", "src0", 0), (100001, "12 34", "en", "src0", 5)], docs.schema)
    src = docs.unionByName(odd)
    stage = [f for _, f in corpus_pipeline.STAGES]
    one = stage[0](spark, src, SF_SMALL)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in docs.collect()}
    rows = [(r.doc_id, r.text) for r in one.collect()]
    two = stage[1](spark, one, SF_SMALL)
    assert {r.doc_id for r in two.collect()} == {i for i, _, low in brute(rows) if i == low}
    three = stage[2](spark, two, SF_SMALL)
    copies = {r.doc_id: r.copies for r in mix(two).collect()}
    assert three.columns == docs.columns and Counter(r.doc_id for r in three.collect()) == Counter({i: n for i, n in copies.items() if n})
    four = stage[3](spark, three, SF_SMALL).collect()
    assert Counter(r.doc_id for r in four) == Counter({i: n for i, n in copies.items() if n})


def test_pipeline_runs_on_an_empty_table(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_repeated_ids_stay_once(spark):
    docs = spark.createDataFrame([(1, "one two three four five", "en", "s", 1), (1, "one two three four five", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 1
