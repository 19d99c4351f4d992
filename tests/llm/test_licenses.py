import random
import re

from pyspark.sql import functions as F

from sentrylake.llm import licenses
from sentrylake.llm.license_texts import TEMPLATES
from sentrylake.llm.queries import op6_license_scans


def plain_shingles(text):
    words = [w for w in (t.strip(".,;:!?\"'()[]{}<>*#/\\|-=_`") for t in (text or "").lower().split()) if w]
    return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def plain_hits(text, templates, containment=0.8):
    """Templates of which some stretch of the text, at most a quarter longer, holds enough shingles."""
    own, found = plain_shingles(text), set()
    for number, (_, template) in enumerate(templates):
        wanted = set(plain_shingles(template))
        at = [i for i, s in enumerate(own) if s in wanted]
        room = -(-5 * len(wanted) // 4)
        if any(len({own[i] for i in at if start <= i < start + room}) >= containment * len(wanted) for start in at):
            found.add(number)
    return found


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words.insert(rng.randrange(len(words) + 1), "extra")
    return " ".join(words)


def corpus(seed=1):
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choices(["licensed", "the", "software", "under", "terms", "of", "lorem", "ipsum"], k=k))
    texts = [None, "", " ", "*** ---", "short", prose(3000)]
    for number, (_, template) in enumerate(TEMPLATES * 6):
        before, after = prose(rng.choice([0, 3, 40, 500])), prose(rng.choice([0, 3, 40, 500]))
        body = edited(template, rng, rng.choice([0, 0, 1, 2]))
        body = body.upper() if number % 5 == 0 else re.sub(" ", "\n * ", body) if number % 5 == 1 else body
        texts.append(f"{before} {body} {after}" if number % 9 else f"{before} {body} {prose(60)} {body}")
    return texts


def test_finds_what_brute_force_finds(spark):
    texts = corpus()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns(
        {"license": F.lit("clash"), "start": F.lit(1), "_text": F.lit(2)})
    rows = licenses.scan_licenses(frame).collect()
    got = {i: set() for i in range(len(texts))}
    for r in rows:
        got[r.doc_id].add(r.template)
        assert r.license == TEMPLATES[r.template][0] and 0.8 <= r.containment <= 1 and 0 <= r.start < r.end
        span = " ".join(texts[r.doc_id].split()[r.start:r.end])
        wanted = set(plain_shingles(TEMPLATES[r.template][1]))
        assert len(set(plain_shingles(span)) & wanted) >= 0.8 * len(wanted)
    for i, text in enumerate(texts):
        want = plain_hits(text, TEMPLATES)
        assert want <= got[i]
        loose = {n for n in got[i] - want if len(set(plain_shingles(text)) & set(plain_shingles(TEMPLATES[n][1])))
                 >= 0.8 * len(set(plain_shingles(TEMPLATES[n][1])))}
        assert got[i] - want == loose  # a little more room than a quarter is still a match
    assert sum(len(g) for g in got.values()) > 60


def test_bands_guarantee_retrieval():
    prepared = licenses.prepare(TEMPLATES, 0.8, 1e-6)
    for size, numbers in prepared.sizes.items():
        for n in numbers:
            similarity = licenses.least_similarity(size, len(prepared.shingles[n]), 0.8)
            assert (1 - similarity) ** prepared.bands <= 1e-6


def test_windows_cover_every_place():
    for size in (1, 2, 3, 5, 8, 40, 113):
        length, step = licenses.window_of(size)
        longest = -(-5 * size // 4)
        for start in range(3 * size):
            first = start // step * step
            assert first <= start and start + longest <= first + length


def test_two_passages_make_two_rows(spark):
    line = "Licensed under the Apache License, Version 2.0."
    text = f"one two {line} " + "word " * 50 + line
    rows = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.start, r.end, r.template, r.containment) for r in rows] == [(2, 9, 3, 1.0), (59, 66, 3, 1.0)]


def test_empty_table_and_query(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    sf_dir = "/root/testdata/sf0.001"
    want = {(r.doc_id, n) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() for n in plain_hits(r.text, TEMPLATES)}
    got = {(r.doc_id, r.template) for r in op6_license_scans(spark, sf_dir).collect()}
    assert got == want and len(want) > 2


def test_usual_licenses_and_the_best_of_related_ones(spark):
    bsd3, agpl, lgpl = (dict(TEMPLATES)[x] for x in ("BSD-3-Clause", "AGPL-3.0-or-later", "LGPL-2.1-or-later"))
    bsd2 = bsd3[:bsd3.index(" Neither the name")]
    texts = {"BSD-2-Clause": bsd2, "BSD-3-Clause": bsd3, "AGPL-3.0-or-later": agpl, "LGPL-2.1-or-later": lgpl,
             "GPL-3.0-or-later": dict(TEMPLATES)["GPL-3.0-or-later"], "GPL-2.0-or-later": dict(TEMPLATES)["GPL-2.0-or-later"],
             "CC-BY-4.0": "This work is licensed under CC BY 4.0.", "CC-BY-NC-SA-4.0": "Text licensed under CC BY-NC-SA 4.0, all of it.",
             "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0", "EPL-2.0": "It is licensed under the Eclipse Public License 2.0 now",
             "Zlib": dict(TEMPLATES)["Zlib"], "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See"}
    rows = licenses.scan_licenses(spark.createDataFrame([(k, f"so it is {v} and so on") for k, v in texts.items()],
                                                        "doc_id string, text string")).collect()
    assert {k: {r.best_license for r in rows if r.doc_id == k} for k in texts} == {k: {k} for k in texts}
