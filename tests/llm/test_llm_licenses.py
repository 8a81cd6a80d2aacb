import textwrap

from indicata.llm.licenses import PHRASES, TEMPLATES, license_scan, template_rows, words_in


def plain(text):
    words = words_in(text)
    places = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    found, best = set(), 0.0
    for line in text.split("\n"):
        own = set(words_in(line))
        for _, label, notice, needed in template_rows(TEMPLATES, 0.9):
            common = len(own & set(notice))
            if common >= needed:
                found.add(label)
                best = max(best, common / len(notice))
    base = sorted({label for _, label in places})
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(found | set(base))), 1.0 if base else best)


TEXTS = [
    "",
    "\n\n",
    "Under the MIT license. UNDER THE MIT-LICENSE under the mit\nlicense",
    "Licensed under the Apache License, Version 2.0.",
    "cc by nc, CC BY-NC 4.0; licensed\nunder CC BY NC",
    "4.0 NC BY CC under Licensed",
    "Redistribution and use in source and binary forms, with or without modification are permitted provided that these conditions are met",
    "This work is licensed under the GNU General Public License, version 3.",
    "this work is under the general public license",
    "ünder the mit license\nx²y under the mit license",
    "permission is hereby granted free of charge to any person " + "filler " * 500 + "obtaining a copy of this software and associated documentation files",
]


def test_matches_plain_search(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r)[1:] for r in license_scan(docs).collect()}
    assert found == {k: plain(t) for k, t in enumerate(TEXTS)}


def test_loose_threshold(spark):
    docs = spark.createDataFrame([(1, "this work is under the general public license")], "doc_id long, text string")
    row = license_scan(docs, share=0.75).first()
    assert row["labels"] == "gpl" and abs(row["score"] - 0.8) < 1e-9


def test_wrapped_notices(spark):
    rows = []
    for k, (label, notice) in enumerate(TEMPLATES):
        words = notice.split()
        rows.append((k, "intro of a file\n" + "\n".join("# " + part for part in textwrap.wrap("Copyright 2020 A. Author " + notice, 36)) + "\nmore text " * 40, label))
        rows.append((100 + k, "\n".join(w + " far apart" * 40 for w in words), ""))
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()}
    for k, text, label in rows:
        same = plain(TEMPLATES[k][1] if label else text)  # the notice on one line; words far apart are none
        assert found[k] == same[5:] and label in found[k][0]
