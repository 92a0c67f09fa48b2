"""Quality, personal data, BPE, chat, pipeline."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_rows import empty, odd_documents
from tidewell.llm import bpe, catalogue, chat, pii, quality


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    unary, pairs, sizes = rng.normal(size=11), rng.normal(size=(2, 2)), np.array([4, 1, 6])
    p, expected = quality.forward_backward(unary, pairs, sizes)
    total, at = np.zeros((2, 2)), 0
    for n in sizes:
        weights, labels = [], []
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            weights.append(np.exp(sum(u / 2 * (2 * b - 1) for u, b in zip(unary[at : at + n], y, strict=True)) + sum(pairs[a, b] for a, b in zip(y, y[1:], strict=False))))
            labels.append(y)
        w, y = np.array(weights) / sum(weights), np.array(labels)
        assert np.allclose(w @ y, p[at : at + n])
        for a in range(2):
            for b in range(2):
                total[a, b] += sum(w @ ((y[:, i] == a) & (y[:, i + 1] == b)) for i in range(n - 1))
        at += n
    assert np.allclose(total, expected)


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    scored = quality.op4(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert len(scored) > 40 and (scored["predicted"] == scored["quality"]).mean() >= 0.95


def test_quality_of_odd_rows(spark):
    chain = quality.fit([("Good prose here.\nMore of it.", 1), ("!!! $$$ ###\n$$$", 0)] * 5)
    docs = odd_documents(spark)
    rows = quality.score(docs, chain).collect()
    assert len(rows) == docs.count() and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert quality.score(empty(spark), chain).count() == 0
    assert quality.fit([]).marginals(quality.line_features([b"x"]), np.array([1]))[0] == pytest.approx(0.5)
    clashing = docs.withColumn("Quality_score", F.lit("mine"))
    again = quality.score(clashing, chain)
    assert sorted(r["_quality_score"] for r in again.collect()) == sorted(r["quality_score"] for r in rows) and quality.keep_good(clashing, chain).columns == clashing.columns


def test_blocks_score_like_whole_documents():
    rng = np.random.default_rng(2)
    chain = quality.Chain(rng.normal(size=quality.FEATURES) / 3, rng.normal(size=(2, 2)), np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    r = random.Random(5)
    for n in (1, 2, 3, 7, 64, 65, 500):
        lines = [" ".join(r.choice(["Ab", "c.", "12", "|", "$$", "é"]) for _ in range(r.randrange(7))) for _ in range(n)]
        raw = "\n".join(lines).encode()
        split = raw.split(b"\n")
        p = chain.marginals(quality.line_features(split), np.array([n]))
        w = np.array([len(x) for x in split]) + 1e-6
        for block in (1, 2, 8, 1000):
            assert quality.score_in_blocks(raw, chain, block) == pytest.approx((p * w).sum() / w.sum(), abs=1e-9)
    assert quality.score_in_blocks(b"a\n" * 300_000, chain, 4096) >= 0


def test_long_documents_score_alike(spark, monkeypatch):
    chain = quality.fit([("Good prose here.\nMore of it.", 1), ("!!! $$$ ###\n$$$", 0)] * 5)
    docs = spark.createDataFrame([(i, "\n".join("Some words." if (i + j) % 3 else "$$ !!" for j in range(5 * i))) for i in range(12)], "doc_id long, text string")
    whole = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, chain).collect()}
    monkeypatch.setattr(quality, "BLOCK", 16)
    assert {r["doc_id"]: r["quality_score"] for r in quality.score(docs, chain).collect()} == pytest.approx(whole)


def test_fit_climbs_its_likelihood():
    documents = [("Good prose here.\nMore of it.\n$$", 1), ("!!! $$$ ###\n$$$", 0), ("Prose.", 1), ("### x", 0), ("", 0)]
    labels, sizes = np.array([y for _, y in documents]), np.array([len(quality.lines_of(t)) for t, _ in documents])

    def likelihood(c):
        x = np.vstack([quality.line_features(quality.lines_of(t)) for t, _ in documents])
        u, total, at = ((x - c.mean) / c.scale) @ c.weights, 0.0, 0
        for y, n in zip(labels, sizes, strict=True):
            energy = lambda v: sum(a / 2 * (2 * b - 1) for a, b in zip(u[at : at + n], v, strict=True)) + sum(c.pairs[a, b] for a, b in zip(v, v[1:], strict=False))  # noqa: B023, E731
            every = [energy([k >> i & 1 for i in range(n)]) for k in range(1 << n)]
            total += (energy([y] * n) - np.log(np.exp(every).sum())) / n * 0.5 / (labels == y).sum()
            at += n
        return total - quality.L2 / 2 * ((c.weights**2).sum() + (c.pairs**2).sum())

    best = quality.fit(documents, epochs=600, rate=0.05)
    rng = np.random.default_rng(0)
    for _ in range(20):  # no step away from it is better
        moved = quality.Chain(best.weights + rng.normal(size=quality.FEATURES) * 0.05, best.pairs + rng.normal(size=(2, 2)) * 0.05, best.mean, best.scale)
        assert likelihood(moved) < likelihood(best)


def test_fit_is_bounded(spark):
    docs = spark.createDataFrame([(i, "Good words here." if i % 2 else "$$ !! ##") for i in range(40)] + [(1, "Good words here."), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)], "doc_id long, quality int")
    chain = quality.learn(docs, labels, max_fit=12, fit_lines=1)
    good, bad = (quality.score(spark.createDataFrame([(1, t)], "doc_id long, text string"), chain).first()["quality_score"] for t in ("Other good words.", "%% !! ##"))
    assert good > bad
    assert quality.learn(docs.limit(0), labels).weights.sum() == 0


def test_a_long_text_shuts_out_no_other(spark):
    words = ["good", "words", "of", "prose", "here"]
    rows = [(i, " ".join(words[i % 5 :]) + " again.\nAnother line of them." if i % 2 else f"$$ !! ## {i}\n%% && |") for i in range(60)]
    rows += [(i, "A long line of good prose.\n" * 200_000) for i in range(60, 66)]
    docs, labels = (spark.createDataFrame(x, y) for x, y in ((rows, "doc_id long, text string"), ([(i, i % 2 if i < 60 else 1) for i in range(66)], "doc_id long, quality int")))
    chain = quality.learn(docs, labels)
    got = {r["doc_id"]: r["quality_predicted"] for r in quality.score(docs.withColumns({"_scored_text": F.lit(1), "scored_text": F.lit("x")}), chain).collect()}
    assert all(got[i] == i % 2 for i in range(60)) and all(got[i] == 1 for i in range(60, 66))


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 40])
def test_sampled_lines_have_their_features(n):
    lines = [f"line {i % 4} of {'x' * i}." for i in range(n)]
    text = "\n".join(lines)
    every, some = quality.line_features(quality.lines_of(text)), quality.sampled_features(text, 5)
    assert len(some) == min(n, 5) and any(np.array_equal(every[i : i + len(some)], some) for i in range(n - len(some) + 1))


def slow_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda x: re.sub("[^0-9]", "", x)
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in patterns for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_equal_the_patterns():
    r = random.Random(4)
    parts = ["a.b@c.de", "x@y@z.w", "@", "1.2.3.4.5.6.7.8", "999.1.1.1", "255.255.0255.1", "4111 1111 1111 1111", "4111-1111", "+1 (377) 555-0271", "+1+2 3 4 5 6 7 8 9 0", "é", " ", "\n", ".", "-", "0", "7", "%x@a-.b.", "١"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(text) == slow_spans(text), text
    assert pii.base_spans("a" * 200_000 + "@" * 1000 + "1" * 100_000) is not None  # linear time


@pytest.mark.parametrize("lot", [50_000, 1])
def test_contexts_discover_identifiers(spark, monkeypatch, lot):
    monkeypatch.setattr(pii, "LOT", lot)  # one word at most: all words are counted and joined
    r = random.Random(3)
    filler = lambda: " ".join(r.choice(["the", "of", "word", "and"]) for _ in range(5))
    rows = [(i, f"{filler()} mailto: u{i}@host{i % 9}.example.org kindly {filler()}") for i in range(60)]
    rows += [(100, f"{filler()} mailto: hidden77[at]host kindly {filler()}"), (101, f"{filler()} chapter 12 {filler()}"), (102, None), (None, "")]
    got = {x["doc_id"]: x for x in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    start = dict(rows)[100].index("hidden")
    assert got[100]["spans"] == f"email:{start}:{start + len('hidden77[at]host')}" and got[100]["n_email"] == 0 and got[100]["n_added"] == 1
    assert got[101]["spans"] == "" and got[102]["spans"] == "" and got[None]["n_added"] == 0
    assert all(got[i]["n_email"] == 1 and got[i]["n_added"] == 0 for i in range(60))


def test_contexts_beside_punctuation(spark):
    assert pii.tokens("see (mail:u1@h.org), Kindly.", [("email", 10, 18)]) == (["see", "mail", "u1@h.org", "kindly"], [("mail", "kindly")])
    long = "x" * 50
    assert pii.tokens(f"{long} 12 {long}", [(None, 51, 53)])[1] == [(pii._word(long), pii._word(long))]
    rows = [(i, f"word mailto:u{i}@host{i % 9}.example.org, kindly {i % 7} , word") for i in range(60)]
    rows += [(100, "of mailto:hidden77[at]host, kindly the"), (101, "of mailto: (hidden78[at]host). Kindly the"), (102, "a , 12 , b")]
    got = {x["doc_id"]: x for x in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[101]
    assert got[101]["spans"] == f"email:{text.index('hidden')}:{text.index(')')}" and got[102]["n_added"] == 0


def test_runs_of_digits_are_candidates_however_they_are_spaced():
    r = random.Random(7)
    for _ in range(300):
        text = "".join(r.choice(["1", "23", "456 ", " ", " ", "-", "(7)", "."]) for _ in range(r.randrange(30)))
        want = set()
        tokens = [m.span() for m in re.finditer(r"[^ ]+", text) if re.search("[0-9]", m[0])]
        for i, (a, _) in enumerate(tokens):
            for _, b in tokens[i + 1 :]:
                if 9 <= len(re.findall("[0-9]", text[a:b])) <= 19:
                    want.add((a, b))
        got = set(pii.candidates(text, [], [(0, len(text))])) - set(pii.candidates(text, []))
        assert want - set(pii.candidates(text, [])) == got
    spaced = " ".join("4111111111111111") + " " + " ".join("987654321")
    assert (0, 31) in pii.candidates(spaced, [], [(0, len(spaced))])


def slow_beliefs(texts):
    """Scores of (kind, value) by the definition: rounds over all mentions of a small corpus held in memory."""
    from collections import Counter, defaultdict

    mentions, seen = [], Counter()
    for x in texts:
        base, failed = pii._found(x)
        every = [*base, *[(None, *c) for c in pii.candidates(x, base, failed)]]
        words, around = pii.tokens(x, every)
        seen.update(words)
        for (kind, a, b), (w, v) in zip(every, around, strict=True):
            passes, fails = pii.standing(x[a:b])
            looks = f"{pii.shape(x[a:b])} {passes}"
            sides = {"shape": [("s", looks)], "before": [("w", w), ("ws", w, looks)] if w else [], "after": [("w", v), ("ws", v, looks)] if v else []}
            mentions.append((kind, x[a:b].lower(), fails, sides))
    occurs = defaultdict(list)
    for m in mentions:
        for side, patterns in m[3].items():
            for p in patterns:
                occurs[side, p].append(m)
    believed = {(m[0], m[1]): 1.0 for m in mentions if m[0]}
    before = None
    while before != believed.keys():
        before, confidence = set(believed), {}
        for (side, p), of in occurs.items():
            for k in pii.KINDS:
                if len({m[1] for m in of if m[0] == k}) >= pii.MIN_SEEDS:
                    total = (max(len(of), seen[p[1]]) if p[0] == "w" else len(of)) + 1
                    hits = sum(m[0] == k or (m[0] is None and (k, m[1]) in believed and not m[2] >> pii.KINDS.index(k) & 1) for m in of)
                    if len(of) >= pii.MIN_CONFIDENCE * total and hits / total >= pii.MIN_CONFIDENCE:
                        confidence[k, side, p] = hits / total
        added = {}
        for k in pii.KINDS:
            sums, n = Counter(), Counter()
            for kind, value, fails, sides in mentions:
                if kind is None:
                    miss = 1.0
                    for side, patterns in sides.items():
                        best = max([confidence.get((k, side, p), 0) for p in patterns], default=0)
                        miss *= 1 - min(best, 0.999)
                    n[value] += 1
                    sums[value] += 0 if fails >> pii.KINDS.index(k) & 1 else 1 - miss
            added |= {(k, v): sums[v] / n[v] for v in n if sums[v] / n[v] >= pii.ACCEPT}
        believed = {(m[0], m[1]): 1.0 for m in mentions if m[0]} | {x: s for x, s in added.items() if x not in believed or believed[x] < 1}
    return believed


def test_beliefs_equal_the_definition(spark):
    r = random.Random(11)
    word = lambda: r.choice(["the", "of", "word", "and", "call", "for", "is"])
    texts = []
    for i in range(90):
        texts.append(f"{word()} {word()} call: +1 ({100 + i}) 555-{1000 + i} {word()}")
        texts.append(f"{word()} card {4000000000000000 + 7 * i} {word()} {10 + i % 9}.{i}.3.4 {word()}")
        texts.append(f"server {i}.1.2.{i % 200} answers" if i % 3 else f"server node{i}-x answers {word()} {i}")
    texts += ["call: 0049-30-1234 now", "server db7 answers", "server db7 answers", "chapter 12 and 13", "+1 (226) 555-4081 190.137.223.204 x", "card 4000000000000002", "", "see call 5 of the 9"]
    found = pii.read(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").filter("what = 'mention'")
    names = {}
    for x in texts:
        base, failed = pii._found(x)
        names |= {pii.value(x[a:b]): x[a:b].lower() for a, b in [(a, b) for _, a, b in base] + pii.candidates(x, base, failed)}
    got = {(pii.KINDS[r["kind"]], names[bytes(r["instance"])]): r["score"] for r in pii.learn(found, spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    want = slow_beliefs(texts)
    assert got == pytest.approx(want) and ("phone", "+1 (226) 555-4081") in got and any(s < 1 for s in got.values())


def test_hidden_identifiers_and_decoys(spark):
    valid = lambda n: next(x for i in range(10) if pii.luhn(x := str(n // 10 * 10 + i)))
    rows = [(i, f"words here {valid(4000000000000000 + 7919 * i)} and +1 ({200 + i}) 555-{2000 + i} there") for i in range(30)]
    pair = f"{4111111111111112} {valid(4999999999990000)}"  # one match of the card rule whose check fails
    decoys = [(200 + i, f"order no {valid(5000000000000000 + 31 * i)[:-1]}{(int(valid(5000000000000000 + 31 * i)[-1]) + 3) % 10} shipped") for i in range(5)]
    rows += [(100, f"a {pair} b"), (101, "mail +1 (226) 555-4081 190.137.223.204 now"), (102, "x" * 1_000_000 + " 1")] + decoys
    got = {r["doc_id"]: r for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100]["spans"] == "card:19:35" and got[100]["n_card"] == 0 and got[100]["n_added"] == 1
    assert got[101]["spans"] == "ip:23:38,phone:5:22" and got[101]["n_added"] == 1 and got[101]["n_spans"] == 2
    assert all(got[i]["n_added"] == 0 for i in [*range(30), 102, *range(200, 205)])


def test_candidates_take_linear_time():
    began = time.time()
    assert pii.candidates("a" * 1_000_000 + " b" + "c" * 1_000_000 + "1", []) != []
    assert pii.base_spans("x" * 500_000 + "+1" + " " * 500_000 + "1.2.3") is not None
    assert time.time() - began < 1


def test_pii_of_odd_rows(spark):
    assert pii.extract(empty(spark)).count() == 0
    assert pii.extract(odd_documents(spark).withColumn("spans", F.lit(1))).count() == odd_documents(spark).count()


def test_bpe_equals_the_library():
    e = bpe.encoder(bpe.default_path())
    r = random.Random(1)
    letters = "abcXYZ'stvm! ,.\t\n\x1c\x85\xa0éßΣσİ́漢字ا😀1234 ﬁ|<>"
    texts = ["", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>  c", "don't 's''s !'s", "a" * 5000, "q" * 300 + "xz" * 99, *["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(800)]]
    for t in texts:
        want = e.tokenizer.encode(t, add_special_tokens=False).ids
        ids = e.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want and e.decode(ids) == e.tokenizer.decode(want, skip_special_tokens=False)
    assert e.encode(None) == b"" and e.decode(b"") == ""


def test_bpe_of_other_files(tmp_path):
    import json

    spec = json.load(open(bpe.default_path(), encoding="utf-8"))
    other = spec | {"normalizer": {"type": "Sequence", "normalizers": [{"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}]}}  # keeps upper case
    other["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "[\\p{L}]+|[^\\s\\p{L}]+"}, "behavior": "Removed", "invert": True}, bpe.BYTES]}
    (tmp_path / "other.json").write_text(json.dumps(other))
    e = bpe.ForcedBoundaryBPE(str(tmp_path / "other.json"))
    for t in ("Hello  World 12.5", "don't É", "<|endoftext|>A"):
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids
    for change in ({"decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}, {"normalizer": None}):
        (tmp_path / "refused.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            bpe.ForcedBoundaryBPE(str(tmp_path / "refused.json"))


def test_forced_cuts_stand_between_no_tokens():
    e = bpe.encoder(bpe.default_path())
    pieces = e.fragments("qzxjkvwqqhello")
    assert "".join(pieces) == "qzxjkvwqqhello" and len(pieces) > 1
    assert all(a[-1] + b[0] not in e.pairs for a, b in zip(pieces, pieces[1:], strict=False))


def test_bpe_table(spark):
    docs = odd_documents(spark).withColumn("ids", F.lit(1))
    coded = bpe.encode(docs)
    assert coded.count() == docs.count() and coded.filter("doc_id = 1003").first()["n_tokens"] == 0
    back = bpe.decode(coded).filter("doc_id = 1000").first()["decoded"]
    assert back == "same</w> text</w>"
    assert bpe.encode(empty(spark)).count() == 0


def test_escapes_round_trip():
    r = random.Random(9)
    for _ in range(2000):
        t = "".join(r.choice(["<", "s>", "/s>", "[", "/", "INST]", "]", "|", "\\", "x", "\n"]) for _ in range(r.randrange(12)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not re.search(r"</?s>|\[/?INST\]|<\|", e)


def test_locating_turns():
    turns = [("user", "hi"), ("assistant", "</s>\n"), ("user", ""), ("as]sist", "<s>[x]\n")]
    x = chat.locate(turns)
    assert x.rewritten_at is None and [chat.unescape(x.output[a:b]) for a, b in x.texts] == [t for _, t in turns]
    assert x.turns[0][0] == 0 and x.turns[-1][1] == len(x.output) and all(a[1] == b[0] for a, b in zip(x.turns, x.turns[1:], strict=False))
    forgets = lambda ts: "".join(f"<{t if i >= len(ts) - 2 else '-'}>" for i, (_, t) in enumerate(ts))
    y = chat.locate([("a", "one"), ("b", "two"), ("a", "six")], forgets)
    assert y.rewritten_at == 2 and y.texts == [(-1, -1), (4, 7), (9, 12)]
    assert chat.locate([]).output == ""


def test_any_text_and_many_turns():
    held = "".join(map(chr, range(0xE000, 0xE100))) + "qxq" + "x" * 99
    x = chat.locate([("user", held), ("assistant", "q" + "x" * 100 + "q"), ("user", "x")])
    assert [x.output[a:b] for a, b in x.texts] == [held, "q" + "x" * 100 + "q", "x"]
    turns = [("user" if i % 2 else "assistant", f"word {i} " * 100) for i in range(5000)]
    began = time.time()
    x = chat.locate(turns)
    assert time.time() - began < 60 and [x.output[a:b] for a, b in x.texts] == [t for _, t in turns]
    short = chat.locate(turns[:300])
    assert short.turns == x.turns[:300] and short.texts == x.texts[:300]


@pytest.mark.parametrize("late", [2, 259, 326])
def test_late_changes_are_seen(late):
    turns = [("a", f"t{i}") for i in range(346)]
    numbered = lambda ts: "".join(f"<{i}:{t}>" for i, (_, t) in enumerate(ts))
    x = chat.locate(turns, numbered)
    assert x.rewritten_at is None and x.output == numbered(turns) and [x.output[a:b] for a, b in x.texts] == [t for _, t in turns]
    forgets = lambda ts: "".join(f"<{t}>" for _, t in (ts if len(ts) <= late else ts[-2:]))
    y = chat.locate(turns, forgets)
    assert y.rewritten_at == late and y.texts[-1] != (-1, -1) and y.texts[0] == (-1, -1)


def test_a_change_that_only_one_prefix_shows():
    turns = [("a", f"t{i}") for i in range(400)]
    once = lambda ts: "".join(f"<{'?' if len(ts) == 300 and i == 0 else t}>" for i, (_, t) in enumerate(ts))
    assert chat.locate(turns, once).rewritten_at == 299


def test_a_template_that_fails_leaves_nothing_behind():
    def fails(turns):
        chat.render(turns)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        chat.locate([("a", "b")], fails)
    assert chat._rendered.cache_info().currsize == 0


def test_chat_of_odd_rows(spark):
    rows = [(1, 0, "user", "a", 1), (1, 1, None, None, 1), (1, 1, "assistant", "x", 1), (1, 1, "assistant", "x", 1), (None, None, "assistant", "q", 1), (2, 5, "system", "s" * 100_000, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 2 and got[None]["loss_chars"] == 1 and got[2]["loss_chars"] == 0
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_oracles(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cursor = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from tidewell.llm import mixing, simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = p.quality_stage(spark, docs, SF).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    unique = p.exact_dedup_stage(spark, good, SF).cache()
    assert unique.columns == docs.columns and unique.count() == good.select("text").distinct().count()
    far = p.near_dedup_stage(spark, unique, SF).cache()
    assert far.count() == simhash.near_duplicates(unique).select("component_id").distinct().count()
    mixed = p.mixing_stage(spark, far, SF).cache()
    assert mixed.columns == docs.columns and mixed.count() == mixing.mix(far, mixing.words()).agg(F.sum("mix_repeats")).first()[0]
    coded = p.encoding_stage(spark, mixed, SF)
    assert coded.count() == mixed.count()
    run = p.run(spark, SF)
    key = lambda r: (r["doc_id"], r["ids_sha256"])
    assert sorted(map(key, run.collect())) == sorted(map(key, coded.collect()))
    none = docs.limit(0)
    for _name, stage in p.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0
