"""Parts of the operators that need no Spark, against plain definitions."""

from __future__ import annotations

import random
import re
import time
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from sigmawatch.llm import bpe_fst, chat_grammar, context_mixing, pii_anchors, simhash_golay
from sigmawatch.llm import toxicity_fm, url_sweep, vamana


# ---- SimHash ----------------------------------------------------------------------------------

def plain_fingerprint(text: str) -> int:
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", "a", "A b C", "a b c d", "a b c d e a b c d", "é 漢\x0bx y z w",
                                  "x " * 999])
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    assert simhash_golay.fingerprint(text) == plain_fingerprint(text)


def test_fingerprints_within_four_bits_share_a_bucket():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for a in base.tolist():
        b = a
        for p in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
            b ^= 1 << p
        keys = [set(simhash_golay.bucket_keys(np.array([x], np.uint64))[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_spanning_links_keep_the_components():
    rng = np.random.default_rng(2)
    centers = rng.integers(0, 2**64, 5, dtype=np.uint64)
    fps = {int(c) ^ (1 << int(i)) ^ (1 << int(j)) for c in centers for i, j in rng.integers(0, 64, (30, 2))}
    fps = np.array(sorted(fps), np.uint64)
    links = simhash_golay.spanning_links(fps, 4)
    parent = {int(f): int(f) for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        for u, v in zip(a.tolist(), b.tolist(), strict=True):
            assert (u ^ v).bit_count() <= 4
            parent[root(u)] = root(v)
    for u in parent:
        for v in parent:
            if (u ^ v).bit_count() <= 4:
                assert root(u) == root(v)
    assert sum(len(a) for a, _ in links) < len(fps)


# ---- PII --------------------------------------------------------------------------------------

def plain_spans(text: str):
    checks = ((pii_anchors.EMAIL, lambda s: True), (pii_anchors.IP, pii_anchors._valid_ip),
              (pii_anchors.CARD, pii_anchors._valid_card), (pii_anchors.PHONE, pii_anchors._valid_phone))
    return sorted((k, m.start(), m.end()) for k, (p, ok) in enumerate(checks)
                  for m in p.finditer(text) if ok(m.group()))


def test_base_spans_are_the_leftmost_matches():
    find, rnd = pii_anchors.Finder(), random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice("a.@b1 2-+()9%_0\n:/X") for _ in range(rnd.randint(0, 40)))
        assert [s for s in find(text) if s[0] < 4] == plain_spans(text)


def test_long_runs_are_read_once():
    find = pii_anchors.Finder()
    for text in ("1" * 500_000, "1." * 250_000, "a" * 250_000 + "@" + "a" * 250_000, "a@" * 250_000,
                 "a://" * 125_000, "a://b?user=" * 40_000, "+1" * 250_000, "1 " * 250_000):
        began = time.process_time()
        find(text)
        assert time.process_time() - began < 20, text[:20]


def test_private_urls_inside_others():
    text = "see http://a.org/?next=http://u:p@b.org/x, or https://c.org/q?token=1&x=https://d.org/?y=2."
    found = [text[a:b] for k, a, b in pii_anchors.Finder()(text) if k == 4]
    assert found == ["http://u:p@b.org/x", "https://c.org/q?token=1&x=https://d.org/?y=2"]


def test_known_spans_and_redaction():
    text = "mail ann.b@x.example.org, card 4111 1111 1111 1111, ip 10.0.0.255, call +1 (483) 555-1712."
    spans = pii_anchors.Finder()(text)
    assert [pii_anchors.KINDS[k] for k, _, _ in spans] == ["email", "ip", "card", "phone"]
    assert pii_anchors.redact(text, spans) == "mail [EMAIL], card [CARD], ip [IP], call [PHONE]."


def test_added_kinds():
    text = "see https://bob:pw@host.example/x and IBAN: DE12500105170648 or account no: short"
    kinds = {pii_anchors.KINDS[k]: text[a:b] for k, a, b in pii_anchors.Finder()(text) if k >= 4}
    assert kinds == {"url": "https://bob:pw@host.example/x", "account": "DE12500105170648"}


def test_leading_zeros_do_not_matter_in_addresses():
    find = pii_anchors.Finder()
    for text, valid in (("0" * 30 + "1.2.3.4", True), ("1.2.3." + "0" * 5000, True), ("0.0.0.0", True),
                        ("0" * 30 + "256.2.3.4", False), ("1.2.3." + "9" * 5000, False)):
        assert [s for s in find(text) if s[0] == 1] == ([(1, 0, len(text))] if valid else [])


@pytest.mark.parametrize("text, value", [
    ("Customer ID: 884213", "884213"), ("User ID: abc12345", "abc12345"), ("mEMBER iD = 774411", "774411"),
    ("\u0130 Member ID: 774411", "774411"),
    ("IBAN DE89370400440532013000", "DE89370400440532013000"),
    ("IBAN: DE89 3704 0044 0532 0130 00 and then", "DE89 3704 0044 0532 0130 00"),
    ("iban no. NO93 8601 1117 947 with more text", "NO93 8601 1117 947"),
    ("IBAN GB82-WEST-1234-5698-7654-32.", "GB82-WEST-1234-5698-7654-32"),
    ("SSN 123-45-6789", "123-45-6789"), ("IBAN: DE89370400440532013000-123", "DE89370400440532013000-123"),
    ("IBAN GB82 WEST 1234 5698 7654 33", None), ("account for 2019", None), ("passport X1234567", None),
    ("SSN 000-45-6789", None)])
def test_usual_forms_of_accounts(text, value):
    spans = pii_anchors.Finder()(text)
    assert [text[a:b] for k, a, b in spans if pii_anchors.KINDS[k] == "account"] == ([value] if value else [])
    assert value is None or value not in pii_anchors.redact(text, spans)


# ---- BPE --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return bpe_fst.Encoder(bpe_fst.load_ranks(bpe_fst.ranks_table()))


def test_ids_equal_tiktoken_and_decode_back(encoder):
    ranks = encoder.transducer.ranks
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                               special_tokens={})
    rnd = random.Random(4)
    for i in range(1500):
        if i % 2:
            text = "".join(rnd.choice("abcdeéöñ 漢字🙂'st\n\t09.,!<|endoftext|>") for _ in range(rnd.randint(0, 80)))
        else:
            text = bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 40))).decode("latin1")
        ids = b"".join(encoder.chunks(text, 16))
        assert array("I", ids).tolist() == theirs.encode_ordinary(text)
        decoder = bpe_fst.Decoder(encoder.transducer.token)
        back = "".join(decoder.feed(ids[j:j + 4])[1] for j in range(0, len(ids), 4)) + decoder.close()
        assert back == text


def test_a_bound_on_states_changes_nothing():
    ranks = bpe_fst.load_ranks(bpe_fst.ranks_table())
    few, many = bpe_fst.Transducer(ranks, 3), bpe_fst.Transducer(ranks)
    for word in (b"understandable", b"xqzjvv" * 5, "naïveté漢字".encode()):
        assert few.encode(word) == many.encode(word)


# ---- chat -------------------------------------------------------------------------------------

def test_any_turn_survives_the_round_trip():
    rnd, parser = random.Random(6), chat_grammar.Parser()
    parts = ["\\", "### ", "</turn>", ": ", "\n", "a", "Assistant", "#", "<", "/turn>", "\\\\", "# ", "## ",
             " ", "</"]
    for text in ("##### # x", "#### ## y"):
        made, start, end = chat_grammar.render("user", text)
        assert parser.parse(made) == ("user", text, start, end)
    for _ in range(20_000):
        role, text = ("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 7))) for _ in range(2))
        made, start, end = chat_grammar.render(role, text)
        assert parser.parse(made) == (role, text, start, end)


def test_very_long_turns_are_scanned_once():
    for text in ("\\" * 1_000_000, "### " * 250_000, "#" * 1_000_000):
        began = time.process_time()
        chat_grammar.render("user", text)
        assert time.process_time() - began < 10


def test_plain_text_is_not_escaped():
    made, start, end = chat_grammar.render("user", "plain: text \\ here")
    assert made[start:end] in ("plain: text \\ here", chat_grammar.escape("plain: text \\ here", chat_grammar.CONTROL))
    assert chat_grammar.render("user", "hello")[0] == "### user: hello</turn>\n"


# ---- URL sweep --------------------------------------------------------------------------------

def test_sweep_keeps_a_stack_of_nested_rules():
    rules = sorted([(b"com\0", b"/", "com/", "allow"), (b"com\0example\0", b"/en/", "example.com/en/", "block"),
                    (b"", b"/x", "/x", "block")])
    urls = sorted([(b"com\0example\0", b"/en/1"), (b"com\0example\0www\0", b"/fr"), (b"net\0", b"/x1"),
                   (b"net\0", b"/y"), (b"com\0examples\0", b"/en/")])
    got = {u: w and w[0] for u, w in zip(urls, url_sweep.sweep(urls, rules), strict=True)}
    assert got == {(b"com\0example\0", b"/en/1"): "example.com/en/", (b"com\0example\0www\0", b"/fr"): "com/",
                   (b"net\0", b"/x1"): "/x", (b"net\0", b"/y"): None, (b"com\0examples\0", b"/en/"): "com/"}


# ---- toxicity ---------------------------------------------------------------------------------

def test_score_is_the_explicit_sum_over_pairs():
    rng = np.random.default_rng(2)
    buckets, held = 64, np.sort(rng.choice(64, 40, replace=False)).astype(np.int32)
    machine = toxicity_fm.Machine(-0.3, held, rng.normal(size=40).astype(np.float32),
                                  rng.normal(size=(40, 5)).astype(np.float32) / 4, buckets)
    w, v = machine.dense()
    rows = [np.sort(rng.choice(64, n, replace=False)).astype(np.int32) for n in (0, 1, 2, 9, 30)]
    got = toxicity_fm.score_rows(machine, w, v, rows)
    for row, score in zip(rows, got, strict=True):
        z = machine.bias + sum(float(w[i]) for i in row)
        z += sum(float(np.dot(v[i].astype(float), v[j].astype(float))) for a, i in enumerate(row) for j in row[:a])
        assert score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)


def test_interactions_are_learned_where_weights_cannot():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(3000):  # toxic exactly if one of the two terms is there without the other
        a, b = rng.random(2) < 0.5
        rows.append(np.array([t for t, on in ((1, a), (2, b)) if on] + [3 + rng.integers(4)], np.int32))
        labels.append(int(a != b))
    machine = toxicity_fm.fit(rows, np.array(labels), 64)
    scores = toxicity_fm.score_rows(machine, *machine.dense(), rows)
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.9


def test_terms_do_not_depend_on_the_chunk():
    text = "Idiot, worthless " + "some words of any kind " * 200 + "x" * 500
    assert (toxicity_fm.Terms()(text) == toxicity_fm.Terms(chunk=1000)(text)).all()
    assert len(toxicity_fm.Terms()("")) == 0 == len(toxicity_fm.Terms()(" \n.,"))


def test_nothing_to_fit_on():
    machine = toxicity_fm.fit([], np.empty(0))
    assert toxicity_fm.score_rows(machine, *machine.dense(), [np.array([5], np.int32)])[0] < 1e-6


def test_few_long_rows_are_not_learned_by_heart():
    rng = np.random.default_rng(11)

    def text(toxic):
        # 300 of 40,000 harmless terms, one of ten insults in a toxic row.
        some = rng.choice(np.arange(100, 40_100), 300, replace=False)
        return np.sort(np.append(some, rng.choice(10, 3, replace=False) if toxic else 50)).astype(np.int32)

    labels = rng.random(1200) < 0.1
    rows = [text(t) for t in labels]
    machine = toxicity_fm.fit(rows[:900], labels[:900].astype(int), 1 << 16)
    scores = toxicity_fm.score_rows(machine, *machine.dense(), rows[900:])
    assert (scores[labels[900:]] >= 0.3).mean() >= 0.9 and (scores[~labels[900:]] >= 0.3).mean() <= 0.01


def test_rare_terms_have_a_weight_whatever_the_sample():
    rows = [np.array([1, 2], np.int32)] * 5000 + [np.array([1, 3], np.int32)] * 3 + [np.array([4], np.int32)] * 2
    machine = toxicity_fm.fit(rows, np.array([0] * 5000 + [1] * 5), 64)
    assert machine.ids.tolist() == [1, 2, 3]  # not the term of two rows
    x = toxicity_fm.evidence(np.array([10, 5000, 3]), np.array([1, 500, 3]), 0.1)
    assert x[0] == np.float32(toxicity_fm.LEAST) and x[1] == 1 and 0.5 < x[2] < toxicity_fm.MOST
    a, b = toxicity_fm.score_rows(machine, *machine.dense(), [np.array([1, 3]), np.array([1, 2])])
    assert a > 10 * b


# ---- context mixing ---------------------------------------------------------------------------

def small_model(texts):
    units, which, _ = context_mixing.distinct(texts)
    times = np.bincount(which)
    counts = np.zeros(1 << 16, np.int64)
    for data, fresh, unit in context_mixing.parts(units):
        np.add.at(counts, context_mixing.pairs(data, fresh),
                  np.repeat(times[unit], np.diff(np.append(fresh, len(data)))))
    code = context_mixing.Code.build(counts)
    tables = [np.zeros((2, 1 << b), np.int64) for b in context_mixing.SLOT_BITS]
    for data, fresh, unit in context_mixing.parts(units):
        context_mixing._add(tables, data, fresh, times[unit], code)
    return context_mixing.fitted(code, tables, texts[:10])


def test_the_model_is_a_probability_distribution():
    model = small_model([b"the cat sat on the mat", b"the dog sat on the cat"] * 20)
    # The decisions of the byte behind a beginning sum to 1 over all bytes.
    total = 0.0
    for c in range(256):
        d = np.frombuffer(b"ca" + bytes((c,)), np.uint8)
        node, bit, slots, depth, _ = context_mixing.decisions(d, np.array([0]), model.code)
        z = model._final(node, model._sum(*model._inputs(slots, depth)))
        last = np.arange(len(z)) >= len(z) - model.code.length[int(d[-2]) * 256 + int(d[-1])]
        total += np.exp(-np.logaddexp(0, np.where(bit == 1, -z, z)[last].astype(float)).sum())
    assert total == pytest.approx(1.0, abs=1e-4)
    assert model.score([b"the ca" + bytes((c,)) for c in range(256)]).max() < 0
    # A NUL byte is a byte like others, not the end of a text.
    whole, cut_short, behind = model.score([b"the cat\x00sat", b"the cat", b"sat"])
    assert whole < cut_short + behind - 0.1


def test_units_are_cut_and_counted_exactly():
    long = b"x" * 1000
    texts = [b"a b  a\n", b"", b"a b", long + b" " + long[:-1] + b"y " + long, b"\x00 \x1f a\x00"]
    units, which, first = context_mixing.distinct(texts)
    words = units.words().to_pylist()
    for i, t in enumerate(texts):
        end = first[i + 1] if i + 1 < len(first) else len(which)
        here = [words[u] for u in which[first[i]:end]]
        assert [w for w in here if w] == re.findall(rb"[^\x20\x09-\x0d]+", t)
    again = context_mixing.from_binary(pa.concat_arrays([pa.array([b"zz"]), units.binary()])[1:])
    assert again.words().to_pylist() == words
    assert sum(len(d) for d, _, _ in context_mixing.parts(units)) == len(units.data)
    assert len(context_mixing.distinct([])[1]) == 0


def test_a_units_score_does_not_depend_on_its_slice():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.choice(list(b"abcdef  \n"), int(n)).astype(np.uint8)) for n in rng.integers(0, 4000, 40)]
    texts.append(b"q" * 100_000)
    model = small_model(texts)
    alone = [model.score([t])[0] for t in texts]
    assert model.score(texts) == pytest.approx(alone, rel=1e-9)


def test_learned_text_costs_less_and_company_does_not_matter():
    model = small_model([b"the cat sat on the mat", b"the dog sat on the cat"] * 20)
    known, strange, empty = model.score([b"the cat sat on the cat", b"zqxj kvwy pfgh uim 9", b""])
    assert known > strange and empty < 0
    assert model.score([b"the cat sat on the cat"])[0] == pytest.approx(known)


def counted_model(texts):
    counts = np.zeros(1 << 16, np.int64)
    for data, fresh, _, behind in context_mixing.runs(*context_mixing.joined(texts)):
        counts += np.bincount(context_mixing.pairs(data, fresh), minlength=1 << 16)
    code = context_mixing.Code.build(counts)
    tables = [np.zeros((2, 1 << b), np.int64) for b in context_mixing.SLOT_BITS]
    context_mixing.add_texts(tables, texts, code)
    return context_mixing.fitted(code, tables, texts[:10])


def test_contexts_reach_across_words():
    model = counted_model([b"red apple falls down", b"blue house stands there"] * 40)
    right, mixed = model.score([b"red apple falls down", b"down apple red falls"])
    assert right > mixed + 1
    # Only the word before tells these apart.
    near, far = model.score([b"apple falls", b"house falls"])
    own, other = model.score([b"apple ", b"house "])
    assert near - own > far - other


def test_pieces_do_not_cut_contexts(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [bytes(rng.choice(list(b"abc  \n"), int(n)).astype(np.uint8)) for n in rng.integers(0, 40, 60)]
    texts += [b"y" * 300 + bytes(rng.choice(list(b"abc"), 700).astype(np.uint8)) + b" z y", b"", b" "]

    def all_contexts(size):
        monkeypatch.setattr(context_mixing, "_CHUNK", size)
        got = []
        for data, fresh, _, behind in context_mixing.runs(*context_mixing.joined(texts)):
            pair = context_mixing.pairs(data, fresh, behind)
            ctx, depth = context_mixing.contexts(data, fresh, behind)
            got.append(np.array([*ctx, depth.astype(np.uint64), pair.astype(np.uint64)]))
        return np.concatenate(got, 1)

    whole = all_contexts(1 << 20)
    assert (all_contexts(1) == whole).all() and (all_contexts(7) == whole).all()
    # No restart inside a long word: all its beginnings are different contexts.
    start = sum(len(t) + 1 for t in texts[:60])
    assert len(np.unique(whole[5, start:start + 1000])) == 1000


def test_a_bytes_decisions_lie_side_by_side():
    texts = [b"the cat sat on the mat", b"quick dogs jump"]
    code = small_model(texts).code
    data, starts = context_mixing.joined(texts)
    node, _, slots, _, _ = context_mixing.decisions(data, starts, code)
    pair = context_mixing.pairs(data, starts)
    of = np.repeat(np.arange(len(data)), code.length[pair])
    for s, bits in zip(slots, context_mixing.SLOT_BITS, strict=True):
        assert s.min() >= 0 and s.max() < 1 << bits
        # One stretch of the table for a byte, a slot of it for each of its nodes.
        assert len(np.unique(of << 32 | s >> 8)) == len(data)
        assert len(np.unique(of << 32 | s)) == len(node)
    # The byte before is part of every context.
    one, other = (context_mixing.decisions(np.frombuffer(t, np.uint8), np.array([0]), code)[2]
                  for t in (b"a x", b"a\tx"))
    assert all(p[-1] >> 8 != q[-1] >> 8 for p, q in zip(one, other, strict=True))


# ---- graph search -----------------------------------------------------------------------------

def test_graph_recall_and_duplicates():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    graph, entries = vamana.build_graph(x, 1)
    assert graph.shape == (3000, vamana.DEGREE)
    q = rng.normal(size=(40, 16)).astype(np.float32)
    found, dist = vamana.beam_search(x, graph, entries, q, 96)
    true = np.argsort(((q[:, None] - x[None]) ** 2).sum(2), 1)[:, :20]
    hits = np.mean([len(set(f[:20]) & set(t)) / 20 for f, t in zip(found, true, strict=True)])
    assert hits > 0.9
    assert (np.diff(dist[:, :20], axis=1) >= 0).all()


@pytest.mark.parametrize("n", [1, 2, 5, 300])
def test_small_shards(n):
    x = np.random.default_rng(n).normal(size=(n, 4)).astype(np.float32)
    graph, entries = vamana.build_graph(x, 1)
    found, _ = vamana.beam_search(x, graph, entries, x[:1], 8)
    assert found[0, 0] == 0
