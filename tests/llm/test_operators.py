import hashlib
import random
import struct
from itertools import combinations

import numpy as np
import pytest

from ledgerlens.llm import bpe, chat, decontamination, language_id, licenses, near_dedup, quality_rules, quality_trees, toxicity, url_filters

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "a", "\n\n", "word " * 3000, "é" * 50, "the the the", "\x1c \x85"]


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "ento", "ando", "re", "stion", "ha", "nt", "ble", "ou"]) + rng.choice(["", "", "x", "yo", "en"]) for _ in range(n))


@pytest.fixture(scope="session")
def vocabulary():
    return bpe.multi_vocabulary()


def odd_docs(spark):
    return spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate([*ODD, ODD[3]])], DOC)


def test_bpe_equals_tiktoken_and_edits(vocabulary):
    import tiktoken

    own = bpe.Encoder(vocabulary)
    other = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens) if t}, special_tokens={})
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\x1c", "\x85", "The", "'s", "ß", "你", "🙂", "12", ".", "__", "x" * 30, "\r\n", "ing", " the"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert own.encode(text) == other.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()
        edited = bpe.EditableEncoding(own, text)
        a = rng.randint(0, len(text))
        edited.replace(a, min(len(text), a + 2), rng.choice(parts))
        assert edited.ids() == own.encode(edited.text)
    small = bpe.Encoder(vocabulary, words=40)  # words leave the store all the time
    for _ in range(300):
        text = " ".join("".join(rng.choices("aeinrst", k=rng.randint(1, 90))) + rng.choice(["", ".", ",", "!", "\n", "\x00"]) for _ in range(rng.randint(0, 12)))
        assert small.encode(text) == other.encode_ordinary(text) and len(small.seen) <= 20 + 24
    word = "".join(rng.choices("aeinrst", k=5000))
    edited = bpe.EditableEncoding(own, word)
    done = edited.bytes_done
    for at in (4900, 4950, 4000):
        edited.replace(at, at + 1, "xy")
        assert edited.ids() == other.encode_ordinary(edited.text)
    assert edited.bytes_done - done < 1500  # only what follows the edits
    table = bpe.PrefixEncoder(vocabulary).append(b"hello").append(b"world")
    assert table.ids() == bpe.PrefixEncoder(vocabulary).append(b"helloworld").ids()
    assert table.truncate(5).ids() == own.piece(b"hello")


def test_bpe_rows(spark, vocabulary):
    got = bpe.encode_documents(odd_docs(spark), vocabulary, with_ids=True).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        text = ([*ODD, ODD[3]][r.doc_id] or "").encode()
        assert r.decoded_sha256 == hashlib.sha256(text).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest() and r.n_tokens == len(r.ids)
    assert bpe.encode_documents(odd_docs(spark).where("false"), vocabulary).count() == 0


def test_toxicity_learns_and_locates(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        bad = k % 5 == 0
        sentences = [words(rng, 8) for _ in range(6)]
        if bad:
            sentences[3] += " vileword"
        rows.append((k, ". ".join(sentences), "en", "s", 0))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, DOC)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model, spans=True).collect()}
    assert all((got[k].score >= 0.3) == (y == 1) for k, y in labels)
    s = got[0].sentences[0]
    assert "vileword" in rows[0][1][s.start : s.end] and len(got[0].sentences) == 1
    assert [r.score for r in toxicity.score(odd_docs(spark), model).collect()][:3] == [0.0, 0.0, pytest.approx(0, abs=0.01)]
    empty = toxicity.train(docs.where("false"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert empty.weights == {}


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    items = [(k, words(rng, 25)) for k in range(5)] + [(9, None), (10, "short")]
    exact, clean = words(rng, 40) + " " + items[2][1].upper() + "! " + words(rng, 30), words(rng, 200)
    near = words(rng, 40) + " " + items[3][1].replace(" ", "  ", 3)[:60] + "q" + items[3][1].replace(" ", "  ", 3)[60:] + " " + words(rng, 10)
    docs = spark.createDataFrame([(1, exact, None, None, 0), (2, clean, None, None, 0), (3, near, None, None, 0), (4, None, None, None, 0), (5, "", None, None, 0)], DOC)
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: (True, [2]), 2: (False, []), 3: (True, [3]), 4: (False, []), 5: (False, [])}
    assert [r.doc_id for r in decontamination.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()] == [2, 4, 5]


def least_edits(pattern, text):
    """Of the pattern against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_finds_fragments_at_every_place():
    rng = random.Random(12)
    item = words(rng, 40)
    index = decontamination.Index([(7, item), (8, words(rng, 40))])
    for size in (40, 41, 60, 80, 100):
        for start in range(len(item) - size + 1):
            part = item[start : start + size].strip()
            if len(part) >= 40:
                text = words(rng, 20) + " " + part + " " + words(rng, 20)
                found = index.find(text)
                assert [x[0] for x in found] == [7] and found[0][3] == 0
                assert part in text[found[0][1] - 1 : found[0][2] + 1], (start, size)
    for step in (8, 10, 13):  # one word in so many is another
        own = item.split()
        for first in range(step):
            text = " ".join("z" * 7 if k % step == first else w for k, w in enumerate(own))
            stretches = [len(x.strip()) for x in text.split("z" * 7)]
            assert max(stretches) < 40 or {x[0] for x in index.find(text)} == {7}
    assert index.find(words(rng, 400)) == []


def test_decontamination_equals_alignment_of_every_window():
    rng, found = random.Random(13), 0
    for turn in range(60):
        item = words(rng, 30)[: rng.choice([33, 39, 45, 62, 70, 79, 95])].strip()
        start = rng.choice([0, 0, rng.randrange(max(1, len(item) - 40))])
        part = list(item[start : start + rng.choice([36, 41, 50, 60, 95])])
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(part))
            part[k : k + 1] = rng.choice([["z"], [], [part[k], "z"]])
        text = " ".join((words(rng, 4) + " " + "".join(part) + " " + words(rng, 4)).split())
        n = min(len(item), 40)
        want = any(least_edits(item[s : s + n], text) <= int(n * 0.05) for s in range(len(item) - n + 1))
        want = want or (len(item) < 80 and least_edits(item, text) <= int(len(item) * 0.05))
        assert bool(decontamination.Index([(1, item)]).find(text)) == want, (item, text)
        found += want
    assert 15 < found < 55


def test_decontamination_finds_short_items_on_word_borders():
    index = decontamination.Index([(1, "What is the capital of France?"), (2, "..."), (3, None), (4, "the capital"), (5, "capital")])
    text = "Well, what is  THE capital of France - do say"
    assert [(x[0], text[x[1] : x[2]]) for x in index.find(text)] == [(1, "what is  THE capital of France"), (4, "THE capital"), (5, "capital")]
    assert index.find("what is the capitals of France") == [] and index.find("of Capital") == [(5, 3, 10, 0)] and index.find("") == []
    long = "one two three four five six seven eight nine ten"
    assert [x[0] for x in decontamination.Index([(1, long), (2, "What is the capital of France?")]).find(f"{long}! What is the capital of france")] == [1, 2]


def test_chat_events_and_digests(spark):
    log = [(1, 0, 0, 1, "start", "user", "hi"), (1, 1, 0, 2, "start", "assistant", "a"), (1, 1, 0, 3, "delta", None, "b"), (1, 1, 0, 4, "regenerate", None, ""), (1, 1, 0, 5, "delta", None, "c<|x"), (1, 0, 0, 6, "edit", None, "ho"), (2, 0, 0, 1, "delta", None, None)]
    folded = chat.fold(spark.createDataFrame(log, "conv_id long, message long, part long, seq long, kind string, role string, text string"))
    assert {(r.conv_id, r.message): (r.role, r.text) for r in folded.collect()} == {(1, 0): ("user", "ho"), (1, 1): ("assistant", "c<|x"), (2, 0): ("", "")}
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None, "a\\n\nb<|"]), rng.choice([None, "", chat.PROBE, "x<\\|y<|", "line\nline", "é" * 20])) for c in (1, 2, 3, None) for t in range(7 if c != 2 else 400)] + [(3, 2, "user", "again"), (3, 2, "user", "again")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r.conv_id: r for r in chat.conversation_digests(chat.fold(chat.events_of(frame))).collect()}
    assert got == {r.conv_id: r for r in chat.digests_of_events(chat.events_of(frame)).collect()}
    key = lambda x: (x[1], x[2] is not None, x[2] or "", x[3] is not None, x[3] or "")
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=key)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars, got[conv].loss_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len(chat.render(r[2] or "", r[3] or "")) for r in own)


def test_language(spark):
    rng = random.Random(4)
    make = lambda a: " ".join("".join(rng.choices(a, k=rng.randint(2, 7))) for _ in range(60))
    rows = [(k, make("abcdetz" if k % 2 else "nopqrsu"), "x" if k % 2 else "y", None, 0) for k in range(200)]
    docs = spark.createDataFrame([*rows, (900, None, None, None, 0), (901, "12 !", "x", None, 0)], DOC)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert all(got[r[0]] == r[2] for r in rows) and got[900] == got[901] == "und"
    bundle, sizes = language_id.bundles(["ab ab", ""])
    assert sizes.tolist() == [5, 0] and not bundle[1].any() and set(np.unique(bundle[0])) <= {-5.0, -3.0, -1.0, 1.0, 3.0, 5.0}


def test_near_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "a b", "A  b", "a b c d e"]
    for _ in range(12):
        base = words(rng, 80).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], DOC)
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(docs).collect()}
    assert got == {k: (len(sets[k]), top(k), top(k) == k) for k in range(len(texts))}
    assert near_dedup.deduplicated(docs).count() == sum(top(k) == k for k in range(len(texts)))


def test_near_dedup_of_odd_rows(spark):
    rng = random.Random(26)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(5, a), (5, b), (5, ""), (3, a.upper()), (9, b), (2, b + " x"), (None, c), (None, c), (7, None), (8, None), (11, "A b"), (12, "a  b"), (13, c), (13, c), (14, words(rng, 30_000))]
    docs = spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], "doc_id long, text string, component_id int, row string, n_shingles int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.classes(docs).collect()), key=lambda x: (x[0] is None, x))
    want = [(2, 2, True), (3, 2, False), (5, 2, False), (5, 2, False), (5, 2, False), (7, 7, True), (8, 8, True), (9, 2, False), (11, 11, True), (12, 11, False), (13, 13, True), (13, 13, True), (14, 14, True), (None, None, True), (None, None, True)]
    assert got == want
    assert near_dedup.classes(docs.where("false")).collect() == [] and near_dedup.deduplicated(docs.where("false")).collect() == []
    one = near_dedup.deduplicated(docs.where("doc_id in (3, 9, 2, 11)").withColumnRenamed("row", "_row").withColumnRenamed("n_shingles", "_n"))
    assert one.columns == ["doc_id", "text", "component_id", "_row", "_n"] and sorted(r.doc_id for r in one.collect()) == [2, 3, 11]


def test_near_dedup_finds_links_at_the_threshold(spark):
    """Pairs of similarities from 0.75 up, each in a text of its own words: recall of the whole search."""
    rng, texts, pairs = random.Random(31), [], 0
    for k in range(400):
        base = [f"w{k}x{j}" for j in range(rng.randint(40, 160))]
        copy, sets = list(base), lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for place in rng.sample(range(len(base)), len(base)):
            other = list(copy)
            other[place] = f"y{place}"
            if 100 * len(sets(base) & sets(other)) < 75 * len(sets(base) | sets(other)):
                break
            copy = other
        texts += [" ".join(base), " ".join(copy)]
        pairs += 1
    got = {r.doc_id: r.component_id for r in near_dedup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(pairs)) >= 0.99 * pairs


def test_hot_keys_are_dealt_to_several_tasks(spark, monkeypatch):
    """Many texts that share half of their words, a long chain of copies, and many exact copies, with small squares."""
    monkeypatch.setattr(near_dedup, "SQUARE", 8)
    rng = random.Random(33)
    common = [words(rng, 30) for _ in range(6)]
    texts = [" ".join([*common[:4], words(rng, 60)]) for _ in range(60)]
    texts += [texts[0]] * 300
    step = words(rng, 200).split()
    for k in range(40):
        step = [*step[:k * 4], f"v{k}", *step[k * 4 + 1 :]]
        texts.append(" ".join(step))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    lead = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if lead[a] != lead[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((lead[a], lead[b]))
                lead = [low if x == high else x for x in lead]
    got = {r.doc_id: r.component_id for r in near_dedup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == dict(enumerate(lead))
    star = spark.createDataFrame([(0, k) for k in range(1, 2000)] + [(k, k + 5000) for k in range(1, 2000)], "u long, v long")
    assert {r.component for r in near_dedup.components(star).collect()} == {0}


def test_deduplicated_with_repeated_and_null_ids(spark):
    rng = random.Random(16)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    rows = [(5, a), (5, b), (5, b + " more"), (3, a), (9, b), (None, c), (None, c), (None, a), (None, d), (7, d), (8, e), (8, e), (4, ""), (4, None), (None, ""), (None, None)]
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in rows], DOC)
    got = near_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    full = [(r.doc_id, r.text) for r in got.collect()]
    by_id = sorted((k if k is not None else 99, {a: "a", b: "b", b + " more": "b", c: "c", d: "d", e: "e"}.get(t, "")) for k, t in full)
    assert by_id == [(3, "a"), (4, ""), (5, "b"), (7, "d"), (8, "e"), (99, ""), (99, ""), (99, "c")]


def test_quality_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(quality_trees.FEATURES)))
    y = ((x[:, 1] > 0) ^ (x[:, 4] > 0.5)).astype(float)
    trees = quality_trees.fit(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    assert quality_trees.fit(x[:0], y[:0]).score(x[:1])[0] == 0.5
    got = quality_trees.score(quality_trees.all_statistics(odd_docs(spark)), trees).collect()
    assert len(got) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)


def brute_repeats(w):
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    return len({i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)})


def test_quality_rules(spark):
    rng = random.Random(7)
    for _ in range(50):
        w = rng.choices(["a", "b", "c"], k=rng.randint(0, 60))
        m = dict(zip(quality_rules.MEASURES, quality_rules.measure("\n".join([" ".join(w), "x", "x", " ", " "])), strict=True))
        assert m["n_repeat_words"] == brute_repeats([*w, "x", "x"]) and m["n_dup_lines"] == 1
    entries = quality_rules.ledger(odd_docs(spark)).cache()
    assert entries.count() == len(ODD) + 1
    by_rule = {r.rule: r.n_failed for r in quality_rules.ablation(entries, "v1").collect()}
    assert by_rule["few_words"] == entries.where("n_words < 20").count()
    assert sorted(r.doc_id for r in quality_rules.kept(odd_docs(spark), "v1").collect()) == sorted(r.doc_id for r in quality_rules.apply_policy(entries, "v1").where("kept").collect())


def test_url_filters(spark):
    urls = ["http://a.example.org/es/x", "https://example.org/en/12", "http://example.org/en/2", "http://Example.ORG", "http://x.com/de/?q", "http://com/fr/a", "http://notexample.org/es/", "ftp://x.net/a/b", None, "nothing", "http://b.com/frx"]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [got[k] for k in range(len(urls))] == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"), ("org/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow")]
    many = [(f"h{k}.net/p{k}/", "block") for k in range(100)]
    rows = spark.createDataFrame([(k, f"http://www.h{k}.net/p{k}/z") for k in range(100)], "page_id long, url string")
    assert all(r.rule == f"h{r.page_id}.net/p{r.page_id}/" for r in url_filters.judge(rows, many).collect())


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    assert [x for x, _, _ in licenses.scan("Hello there.\n" + mit + "\nReleased under the MIT License.")] == ["MIT", "MIT"]
    assert licenses.scan("no such thing") == [] and [x[0] for x in licenses.scan("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.")] == ["unknown"]
    assert all(r.n_found == 0 for r in licenses.scan_documents(odd_docs(spark)).collect())


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")


def test_licenses_in_their_standard_wording():
    cut = lambda text, k, n: "\n\n".join(text.split("\n\n")[k:n])
    cases = [
        (APACHE, "Apache-2.0"), (cut(APACHE, 0, 1).rsplit("\n", 1)[0], "Apache-2.0"), (MIT, "MIT"), (cut(MIT, 0, 2), "MIT"), (BSD, "BSD-2-Clause"), (BSD.replace("1. ", "(a) ").replace("2. ", "(b) "), "BSD-2-Clause"), (BSD.replace("1. ", "* ").replace("2. ", "* "), "BSD-2-Clause"),
        (GPL, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (cut(GPL, 0, 1), "GPL-3.0-or-later"), (cut(GPL2, 0, 1), "GPL-2.0-or-later"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("This work is licensed under the GNU General Public License version\n3.", "GPL-3.0"), ("Released under the MIT License.", "MIT"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0-only"),
    ]
    for text, want in cases:
        for own in (text, text.replace("\n", "\r\n"), "".join(f" * {line}\n" for line in text.split("\n")), " ".join(text.split())):
            found = licenses.scan(f"Some words.\n{own}\nOther words.")
            assert [x for x, _, _ in found] == [want], own
    start, end = licenses.scan(f"Some words.\n{BSD}\nOther words.")[0][1:]
    assert f"Some words.\n{BSD}\nOther words."[start:end] == BSD
    assert licenses.scan("Released under. The MIT license") == licenses.scan("not released under the MIT license") == []


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL DAMAGES."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD3 = (
    BSD
    + """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
)


def test_licenses_of_whole_files():
    gpl = lambda name, version: GPL.replace("General Public", f"{name} General Public").replace("version 3", f"version {version}")
    cases = [(ISC, "ISC"), (MPL, "MPL-2.0"), (BSD3, "BSD-3-Clause"), (gpl("Lesser", "2.1"), "LGPL-2.1-or-later"), (gpl("Lesser", "3").replace("program", "library"), "LGPL-3.0-or-later"), (gpl("Affero", "3"), "AGPL-3.0-or-later")]
    cases += [(f"SPDX-License-Identifier: {x}", x) for x in licenses.SPDX]
    cases += [("This is free and unencumbered software released into the public domain.", "Unlicense"), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"), (APACHE, "Apache-2.0"), (MIT, "MIT")]
    for text, want in cases:
        head = "Copyright (c) 2019 Some One\nAll rights reserved.\n\n"
        for own in (text, head + text, "".join(f"// {x}\n" for x in (head + text).split("\n")), "/*\n" + "".join(f" * {x}\n" for x in text.split("\n")) + " */\nint main() {}"):
            assert [x for x, _, _ in licenses.scan(own)] == [want], own
    assert [x for x, _, _ in licenses.scan(MIT.replace("\n\n", "\n\nCopyright (c) 2001, 2003 A. B.\n\n", 1))] == ["MIT"]
    assert [x for x, _, _ in licenses.scan(f"{MIT}\n\n{APACHE}\n\n{BSD3}\n{BSD}\n")] == ["MIT", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause"]


def test_licences_equal_brute_force():
    """Texts of known and other sentences in any order: identifiers looked up one by one, rules tried one by one."""
    rng, texts = random.Random(21), list(licenses.SENTENCES)
    used = set()
    for _ in range(400):
        if rng.random() < 0.5:
            chosen = []
            for _ in range(rng.randint(1, 3)):
                own = rng.choice(licenses.RULES)[0]
                chosen += [rng.choice([t for t in texts if licenses.SENTENCES[t] == i]) for i in own[: rng.randint(1, len(own))]]
        else:
            chosen = rng.choices(texts, k=rng.randint(1, 8))
        for _ in range(rng.randint(0, 2)):
            chosen.insert(rng.randint(0, len(chosen)), "nothing of the kind stands here")
        ids, want, at = [licenses.SENTENCES.get(x, "") for x in chosen], [], 0
        while at < len(ids):
            for sequence, licence in licenses.RULES:
                if all(at + k < len(ids) and ids[at + k] == i for k, i in enumerate(sequence)):
                    want.append(licence)
                    at += len(sequence)
                    break
            else:
                if ids[at] and ids[at] not in licenses.PLAIN:
                    want.append("unknown")
                at += 1
        lines = [x if "spdx" in x else x.replace(" ", rng.choice([" ", "\n", "\n// "]), 1) for x in chosen]
        text = "".join(f"{x.capitalize()}.{rng.choice([' ', chr(10), chr(10) + '# '])}" for x in lines)
        assert [x for x, _, _ in licenses.scan(text)] == want, text
        used |= set(want)
    assert len(used) >= 25


def test_licence_rows(spark):
    rows = [(k, t) for k, t in enumerate([*ODD, ODD[3]])] + [(None, MIT), (7, MIT), (7, MIT), (8, ("Some words stand here. " * 20_000) + APACHE)]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, licenses string, n_found int")
    got = [(r.doc_id, r.licenses, r.n_found) for r in licenses.scan_documents(docs).collect()]
    assert len(got) == len(rows) and len([x for x in got if x[2]]) == 4
    assert sum(x[1] == ["MIT"] for x in got) == 3 and [x[0] for x in got if x[1] == ["Apache-2.0"]] == [8]
    assert licenses.scan_documents(docs.where("false")).collect() == []


def test_toxicity_equals_its_definition(spark):
    """Noisy-or from the definition: a document is clean if each of its sentences is."""
    import math
    import re

    rng = random.Random(41)
    weights = {f: rng.uniform(0.2, 4) for w in ("vile", "bad", "grim", "ento") for f in toxicity.features(w)}
    model = toxicity.Model(weights, -5.0)
    for _ in range(200):
        text = "".join(words(rng, rng.randint(0, 4)) + rng.choice(["", " vile", " Bad-grim", " VILEST"]) + rng.choice([". ", "!", "?\n", "\n\n", " "]) for _ in range(rng.randint(0, 8)))
        clean, found = 1.0, []
        for m in re.finditer(r"[^.!?\n]+", text):
            z = -5.0
            for w in re.findall(r"\w+", m[0].lower()):
                z += sum(weights.get(f, 0) for f in {w: 0} | {w[:k] + "*": 0 for k in (3, 4, 5, 6) if len(w) >= k})
            s = 1 / (1 + math.exp(-z))
            clean *= 1 - s
            if s >= toxicity.THRESHOLD:
                found.append((m.start(), m.end(), pytest.approx(s)))
        assert model.score(text) == pytest.approx(1 - clean, abs=1e-9)
        p, spans = model.score(text, True)
        assert p == pytest.approx(1 - clean, abs=1e-9) and spans == found
    rows = [(None, "vile vile vile"), (1, "vile vile vile"), (1, "vile vile vile"), (2, None), (3, ""), (4, "fine. " * 30_000)]
    docs = spark.createDataFrame([(k, t, 0.5, "x") for k, t in rows], "doc_id long, text string, score double, y string")
    got = sorted((str(r.doc_id), r.score >= 0.3) for r in toxicity.score(docs, model).collect())
    assert got == [("1", True), ("1", True), ("2", False), ("3", False), ("4", True), ("None", True)]  # so many sentences of little each add up
    assert sorted(str(r.doc_id) for r in toxicity.flagged(docs.where("doc_id <> 4"), model).collect()) == ["2", "3"]
    assert toxicity.score(docs.where("false"), model).collect() == []


def test_toxicity_gradient_is_that_of_the_likelihood():
    """The fitted weights are better by the definition of the likelihood than those around them."""
    rng = np.random.default_rng(5)
    got = {"y": [], "n": [], "sizes": [], "ids": []}
    for k in range(300):
        sentences = [rng.integers(0, 6, rng.integers(1, 4)).tolist() for _ in range(rng.integers(1, 5))]
        got["y"].append(float(any(0 in s or 1 in s for s in sentences)))
        got["n"].append(len(sentences) + 1)
        got["sizes"].append([len(s) for s in sentences])
        got["ids"].append([i for s in sentences for i in s])
    weights, bias = toxicity._fit(got, {f"f{k}": k for k in range(6)}, np.ones(6), steps=1500)
    w = np.array([weights.get(f"f{k}", 0.0) for k in range(6)])

    def loss(w, b):
        total = 0.005 * (w**2).sum()
        for y, n, sizes, ids in zip(got["y"], got["n"], got["sizes"], got["ids"], strict=True):
            clean, at = (1 - 1 / (1 + np.exp(-b))) ** (n - len(sizes)), 0
            for size in sizes:
                clean *= 1 - 1 / (1 + np.exp(-(b + w[ids[at : at + size]].sum())))
                at += size
            total -= np.log(max(1 - clean, 1e-12)) if y else np.log(max(clean, 1e-12))
        return total

    best = loss(w, bias)
    for k in range(6):
        for move in (0.3, -0.3):
            other = w.copy()
            other[k] = max(0, other[k] + move)
            assert loss(other, bias) >= best - 1e-2
    assert loss(w, bias + 0.3) >= best - 1e-2 and loss(w, bias - 0.3) >= best - 1e-2
    assert min(w[:2]) > 5 * max(w[2:])


def test_language_bundles_equal_bind_permute_bundle(spark, monkeypatch):
    """Vectors bound letter by letter, permuted step by step, bundled one by one; blocks change nothing."""
    rng = random.Random(44)
    texts = ["", "12!", "A b", "Straße, 12 İstanbul!", "你好 世界", *("".join(rng.choices("abcdé ,你", k=rng.randint(1, 300))) for _ in range(20)), "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000))]

    def plain(text):
        letters = [0]
        for c in text.lower():
            if c.isalpha():
                letters.append(ord(c))
            elif letters[-1]:
                letters.append(0)
        if letters[-1]:
            letters.append(0)
        total, n = np.zeros(language_id.DIM), 0
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            total += np.roll(language_id.letter_vector(a), 2).astype(int) * np.roll(language_id.letter_vector(b), 1) * language_id.letter_vector(c)
            n += 1
        return total, n

    want = [plain(t) for t in texts]
    for block in (4096, 7):
        monkeypatch.setattr(language_id, "BLOCK", block)
        own = texts if block > 100 else texts[:12]
        got, sizes = language_id.bundles(own)
        assert sizes.tolist() == [n for _, n in want[: len(own)]]
        assert all(np.array_equal(g, w) for g, (w, _) in zip(got, want, strict=False))
    monkeypatch.setattr(language_id, "BLOCK", 4096)
    model = {"x": want[9][0], "y": want[10][0]}
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(5, texts[5], 1), (None, texts[9], 1)], "doc_id long, text string, score int")
    for r in language_id.predict(docs, model).collect():
        total, n = want[r.doc_id if r.doc_id is not None else 9]
        cosines = {k: total @ v / (np.linalg.norm(total) * np.linalg.norm(v)) if n else 0 for k, v in model.items()}
        assert r.lang_pred == (max(sorted(cosines), key=cosines.get) if n else "und") and r.score == pytest.approx(max(0, *cosines.values()), abs=1e-5)
    assert language_id.predict(docs.where("false"), model).collect() == []
    assert language_id.train(docs.withColumnRenamed("score", "lang").selectExpr("doc_id", "text", "cast(null as string) lang")) == {}


def test_trees_equal_a_walk_node_by_node(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(400, len(quality_trees.FEATURES))), 1)  # many ties
    y = (x[:, 2] + x[:, 3] > 0.4).astype(float)
    trees = quality_trees.fit(x, y)
    for row, got in zip(x, trees.raw(x), strict=True):
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < 2**quality_trees.DEPTH - 1:
                node = 2 * node + (2 if row[trees.feature[t, node]] > trees.cut[t, node] else 1)
            total += trees.value[t, node - (2**quality_trees.DEPTH - 1)]
        assert got == pytest.approx(total)
    # the first split is the best of all, tried one by one
    p = (y.sum() + 0.5) / (len(y) + 1)
    g, h = p - y, np.full(len(y), p * (1 - p))
    gain = lambda part: g[part].sum() ** 2 / (h[part].sum() + quality_trees.RIDGE)
    best = max(gain(x[:, j] <= cut) + gain(x[:, j] > cut) for j in range(x.shape[1]) for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality_trees.BINS + 1)[1:-1])))
    first = x[:, trees.feature[0, 0]] <= trees.cut[0, 0]
    assert gain(first) + gain(~first) == pytest.approx(best)
    stats = quality_trees.all_statistics(odd_docs(spark))
    assert quality_trees.score(stats.where("false"), trees).collect() == [] and quality_trees.all_statistics(odd_docs(spark).where("false")).collect() == []
    nothing = quality_trees.train(stats, spark.createDataFrame([], "doc_id long, quality int"))
    assert len(nothing.feature) == 0 and {r.score for r in quality_trees.score(stats, nothing).collect()} == {0.5}


def test_decontamination_in_passes_and_of_odd_rows(spark):
    rng = random.Random(51)
    items = [(k, words(rng, 40)) for k in range(12)] + [(3, words(rng, 40)), (20, "tiny item"), (21, None), (22, "..."), (5, None)]
    texts = [None, "", "tiny  ITEM", *(words(rng, 20) + " " + t + " " + words(rng, 20) for _, t in items[:13]), words(rng, 30_000) + " " + items[7][1], words(rng, 300)]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)] + [(4, texts[4], 1, 2), (None, texts[4], 1, 2)], "doc_id long, text string, spans int, item_id int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: (str(r.doc_id), r.contaminated, r.item_ids, [tuple(x) for x in r.spans])
    one = sorted(map(key, decontamination.leaks(docs, benchmark).collect()))
    several = sorted(map(key, decontamination.leaks(docs, benchmark, block_chars=700).collect()))
    assert one == several and len(one) == len(texts) + 2 and len(decontamination.blocks(benchmark, 700)) > 3
    index = decontamination.Index(items)
    assert one == sorted((str(k), bool(f), sorted({x[0] for x in f}), sorted(f)) for k, t in [*enumerate(texts), (4, texts[4]), (None, texts[4])] for f in [index.find(t or "")])
    kept = [r.doc_id for r in decontamination.clean(docs, benchmark, block_chars=700).collect()]
    assert sorted(kept) == [0, 1, len(texts) - 1]
    assert decontamination.leaks(docs.where("false"), benchmark).collect() == []
    assert not any(r.contaminated for r in decontamination.leaks(docs, benchmark.where("false")).collect())


def test_chat_folds_long_logs_in_parts(spark):
    """Events of random kinds against a fold one by one; a message of very many deltas, and a conversation of many turns."""
    rng, log = random.Random(61), []
    for conv in (1, 2, None):
        for message in range(30):
            for seq in rng.sample(range(100), rng.randint(1, 8)):
                log.append((conv, message, 0, seq, rng.choice(["start", "delta", "delta", "edit", "regenerate", "odd"]), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "<|im_end|>"])))
    log += [(9, 0, 0, k, "delta", "assistant" if k == 5 else None, f"{k};") for k in range(30_000)] + [(9, 0, 0, 12_000, "regenerate", None, "new;")]
    rank = {"start": 0, "regenerate": 1, "edit": 2}
    want = {}
    for e in sorted(log, key=lambda e: (str(e[0]), e[1], e[2], e[3], rank.get(e[4], 3), e[5] is not None, e[5] or "", e[6] is not None, e[6] or "")):
        role, parts = want.setdefault(e[:3], ["", []])
        if e[4] in rank:
            parts.clear()
        parts.append(e[6] or "")
        want[e[:3]][0] = e[5] if e[5] is not None else role
    events = spark.createDataFrame(log, "conv_id long, message long, part long, seq long, kind string, role string, text string").repartition(5)
    got = {(r.conv_id, r.message, r.part): (r.role, r.text) for r in chat.fold(events).collect()}
    assert got == {k: (role, "".join(parts)) for k, (role, parts) in want.items()}
    assert sorted(map(str, chat.digests_of_events(events).collect())) == sorted(map(str, chat.conversation_digests(chat.fold(events)).collect()))
    assert chat.digests_of_events(events.where("false")).collect() == []
    assert chat.fold(events.where("false")).collect() == [] and chat.conversation_digests(chat.fold(events.where("false"))).collect() == []
    rows = [(1, k, "assistant", "é" * 500 + "<|") for k in range(1500)]  # more than a piece
    r = chat.conversation_digests(chat.fold(chat.events_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).first()
    assert r.loss_sha256 == hashlib.sha256("".join(x[3] for x in rows).encode()).hexdigest() and r.n_turns == 1500


def test_url_filters_of_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "http://a.org/", 5), (2, "", 5), (3, "://", 5), (4, "http://a.org/" + "x" * 100_000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    got = sorted((str(r.page_id), r.host, r.rule, r.verdict) for r in url_filters.judge(pages).collect())
    assert got == [("1", "", None, "allow"), ("1", "", None, "allow"), ("2", "", None, "allow"), ("3", "", None, "allow"), ("4", "a.org", "org/", "allow"), ("None", "a.org", "org/", "allow")]
    assert url_filters.judge(pages.where("false")).collect() == []
    assert {r.verdict for r in url_filters.judge(pages, []).collect()} == {"allow"}
    same = url_filters.judge(pages, [("org/", "block"), ("org/", "allow")])
    assert {r.verdict for r in same.where("rule is not null").collect()} == {"block"}
    # a rule list of thousands, joined with the pages rather than put into the plan, gives the same
    many = [(f"h{k % 50}.net/p{k}/", "block") for k in range(3000)] + [("net/", "allow"), ("h7.net/p7/q", "allow")]
    urls = spark.createDataFrame([(k, f"http://x.h{k % 50}.net/p{k}/z") for k in range(0, 3200, 7)] + [(-1, None), (-2, "http://h7.net/p7/qq"), (-2, "http://h7.net/p7/qq")], "page_id long, url string")
    for r in url_filters.judge(urls, many).collect():
        want = None if r.page_id == -1 else "h7.net/p7/q" if r.page_id == -2 else f"h{r.page_id % 50}.net/p{r.page_id}/" if r.page_id < 3000 else "net/"
        assert r.rule == want, r


def test_quality_rules_of_odd_rows(spark):
    rows = [(None, "word " * 40), (1, None), (1, None), (2, "n_words " * 30_000)]
    docs = spark.createDataFrame([(k, t, 7, "z") for k, t in rows], "doc_id long, text string, n_words int, `_Entry` string")
    assert sorted((str(r.doc_id), r.failures) for r in quality_rules.ledger(docs).collect()) == sorted((str(k), sum(1 << i for i, rule in enumerate(quality_rules.RULES.values()) if eval(rule, {}, dict(zip(quality_rules.MEASURES, quality_rules.measure(t or ""), strict=True))))) for k, t in rows)
    assert quality_rules.kept(docs, "v1").columns == docs.columns and quality_rules.ledger(docs.where("false")).collect() == []
    entries = quality_rules.ledger(docs)
    each = [r.failures for r in entries.collect()]
    for r in quality_rules.ablation(entries, "v1").collect():
        bit = 1 << list(quality_rules.RULES).index(r.rule)
        assert r.n_failed == sum(bool(f & bit) for f in each) and r.n_only == sum(f == bit for f in each)
