"""License scans against a search without filters."""

import re

import duckdb

from roadpulse.llm import licenses as L
from roadpulse.llm import queries, sql

DOCS = "doc_id long, text string"
PAD = " ".join(f"w{i}" for i in range(150))
TEXTS = [
    (1, "Released under the MIT License."),
    (2, f"{PAD} this file: licensed under the apache\nlicense, version 2.0 {PAD}"),
    (3, "mit license MIT LICENSE mit"),
    (4, None),
    (5, ""),
    (6, PAD),
    (7, "This work is licensed under GNU General Public License version 3"),
    (8, "license mit under the released"),
    (9, f"{PAD} Licensed under CC BY-NC 4.0. {PAD}"),
    (9, "all rights reserved; no part may be reproduced without any written permission"),
    (None, "general public license"),
]


def by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    places = [
        (label, i)
        for phrase, label in L.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    held = []
    for start in range(0, max(len(words) - 1 - L.STEP, 0) + 1, L.STEP):
        block = set(words[start : start + L.BLOCK])
        for label, template in L.TEMPLATES:
            own = set(L.template_words(template))
            if len(own & block) >= L.needed(len(own)):
                held.append((label, len(own & block) / len(own)))
    labels = sorted({x for x, _ in places} | {x for x, _ in held})
    return len(words), sorted(places), labels, 1.0 if places else max([s for _, s in held], default=0.0)


def test_equals_a_search_without_filters(spark, prose):
    rows = TEXTS + [(100 + i, t) for i, t in enumerate(prose)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], DOCS + ", k string, block int")
    got = L.scan_licenses(docs).collect()
    found = sorted(
        (str(r["doc_id"]), r["n_words"], sorted((p["label"], p["word"]) for p in r["places"]), sorted({*r["base_labels"], *r["held_labels"]}), round(r["score"], 9))
        for r in got
    )
    want = sorted((str(i), n, p, s, round(c, 9)) for i, t in rows for n, p, s, c in [by_hand(t)])
    assert found == want


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


def test_each_license_is_told_from_the_others(spark, tmp_path):
    given = [
        ("Released under the MIT License", ["mit"]),
        ("Released under the BSD License", []),
        ("Licensed under the Apache License, Version 2.0", ["apache"]),
        ("Licensed under the Mozilla Public License, Version 2.0", []),
        ("This work is licensed under the GNU General Public License, version 3", ["gpl"]),
        ("Licensed under CC BY 4.0", ["cc-by"]),
        ("Licensed under CC BY 3.0", ["cc-by"]),
        ("Licensed under CC BY-NC 4.0", ["cc-by-nc"]),
        ("Licensed under CC BY-SA 4.0", ["cc-by-sa"]),
        ("Licensed under CC BY-ND 4.0", []),
        ("Licensed under CC BY-NC-SA 4.0", []),
        ("Licensed under CC BY-SA 4.0, the figures licensed under CC BY 4.0", ["cc-by", "cc-by-sa"]),
        *[(t, [label]) for label, t in L.TEMPLATES if t not in L.NAMES],
        ("you can redistribute it and/or modify it under the terms of the GNU General Public License", ["gpl"]),
    ]
    # Also far into a text, and with a name only in a block where its template does not hold.
    given += [(f"{PAD} {t}. {PAD}", want) for t, want in given]
    given += [(f"Released under the BSD License {PAD} mit {PAD}", []), ("", []), (None, [])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(given)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["labels"].split(",") if r["labels"] else [] for r in queries.op1_license_scans(spark, str(tmp_path)).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(given)] == given
    found = duckdb.connect()
    found.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    rows = found.sql(sql.OP1)
    at = [rows.columns.index(c) for c in ("doc_id", "labels")]
    assert {r[at[0]]: r[at[1]].split(",") if r[at[1]] else [] for r in rows.fetchall()} == got
