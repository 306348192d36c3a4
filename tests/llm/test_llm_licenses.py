import math
import random
import re

from corpus import empty_documents, lowered, odd_documents
from quarrylake.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "MIT  License mit-license", "the GNU general\npublic license and Apache License", "cc by cc BY-nc 4.0", "mit x license", None, "", "...",
    "This work is licensed under the GNU General Public License, version 3.\nÉ mit LICENSE É",
    "Released under ### the MIT*** License", "Licensed under the Apache License.", "released the mit license", "version 2.0 Apache License licensed the under",
    "x " * 30_000 + "mit license", "apache license apache license apache",
]


def plain(text):
    split = WORD.findall(lowered(text or ""))
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(split)) if split[i:i + len(parts)] == parts]
        places += at
        if at:
            base.add(label)
    sets = [set(WORD.findall(lowered(t))) for _, t in licenses.TEMPLATES]
    met = []
    for k, (_, template) in enumerate(licenses.TEMPLATES):
        length = math.ceil(1.5 * len(WORD.findall(lowered(template))))
        for i in (i for i, w in enumerate(split) if w in sets[k]):
            n = len(sets[k] & set(split[i:i + length]))
            if n / len(sets[k]) >= licenses.CONTAINMENT - 1e-9:
                met.append((k, i, i + length, n / len(sets[k]), n))
    twin = lambda a, b: a != b and len(sets[a] & sets[b]) / len(sets[a]) >= licenses.CONTAINMENT - 1e-9
    best = [m for m in met if not any(twin(m[0], o[0]) and o[1] < m[2] and m[1] < o[2] and o[3:] > m[3:] for o in met)]
    labels = {licenses.TEMPLATES[m[0]][0] for m in best}
    score = max((m[3] for m in best), default=0.5 if base else 0.0)
    return len(split), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in licenses.license_labels(docs).collect()}


NOTICE = """it under the terms of the GNU {}General Public License as
# published by the Free Software Foundation, either version 3 of the License,
# or any later version"""
GRANT = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files"
CLAUSE = "Redistribution and use in source and binary forms, with or\n  without modification, are permitted provided that\n  the following conditions are met"


def test_against_all_blocks_and_templates(spark):
    draw = random.Random(1)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in WORD.findall(lowered(t))})
    texts = TEXTS + [" ".join(draw.choice(vocabulary) if draw.random() < 0.8 else "filler" for _ in range(draw.randrange(120))) for _ in range(60)]
    for _ in range(40):
        parts = [t for _, t in draw.sample(licenses.TEMPLATES, 2)]
        split = " some words between ".join(parts).split()
        texts.append("\n".join(" ".join(w for w in split if draw.random() < 0.93).split(" ")))
    got = found(spark, texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == plain(text), (i, text)


def test_one_family_gives_one_label(spark):
    names = ("", "Lesser ", "Affero ")
    texts = [NOTICE.format(n) for n in names] + [NOTICE.format(n).split(", either")[0] for n in names[1:]]
    texts.append(NOTICE.format("") + " filler" * 80 + " " + NOTICE.format("Lesser "))
    got = [found(spark, texts)[i].labels for i in range(len(texts))]
    gpl, lgpl, agpl = (f"spdx:{x}-3.0-or-later" for x in ("gpl", "lgpl", "agpl"))
    assert got == [f"gpl,{gpl}", lgpl, agpl, lgpl, agpl, f"gpl,{gpl},{lgpl}"]


def test_notices_over_several_lines(spark):
    got = found(spark, [GRANT, CLAUSE, "so\n" + GRANT + "\n\n" + CLAUSE + "\nand on", GRANT.replace("\n", " x" * 40 + " ")])
    assert [got[i].labels for i in range(4)] == ["spdx:mit", "spdx:bsd", "spdx:bsd,spdx:mit", ""]
    assert [got[i].score for i in range(4)] == [1.0, 1.0, 1.0, 0.0]


def test_blocks_name_their_place(spark):
    docs = spark.createDataFrame([(1, "x\nReleased under the MIT License.\ny y y y y y y y\nreleased under the mit")], "doc_id long, text string")
    got = sorted((r.first, r.end, r.label, r.share) for r in licenses.license_blocks(docs).collect())
    assert (1, 9, "spdx:mit", 1.0) in got and (14, 22, "spdx:mit", 0.8) in got and {r[2] for r in got} == {"spdx:mit"}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = licenses.license_labels(docs).collect()
    assert len(got) == docs.count()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(d.doc_id), plain(d.text)[0]) for d in docs.collect())
    assert licenses.license_labels(empty_documents(spark)).count() == 0
