"""Each text operator on awkward rows, against a plain version or an exact round trip."""

import base64
import bz2
import gzip
import lzma
import re
import zlib
from collections import defaultdict
from urllib.parse import quote

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltgate.llm import cotraining, language, minhash, queries, toxicity
from siltgate.llm.cascade import RULES, Page, judge, rule_order
from siltgate.llm.decontamination import contaminated
from siltgate.llm.minhash import near_duplicates
from siltgate.llm.packing import Packer, Sizes, pack_documents
from siltgate.llm.preferences import format_preferences, swapped_answers
from siltgate.llm.secrets import Unwrapping, redacted, scan, scan_secrets
from siltgate.llm.substring import Sketch, remove_repeats
from siltgate.llm.text import word_hashes
from siltgate.llm.tokens import ByteBpe

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau phi chi".split()
SMALL = Sketch(cell_bits=12, block_bits=10, chunk_windows=64)


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def rows(spark, *pairs):
    """Documents with columns whose names clash with those of results."""
    ddl = "doc_id long, text string, score string, kept string, start string, mark string"
    return spark.createDataFrame([(*p, "s", "k", "x", "m") for p in pairs], ddl)


def awkward(spark):
    long_text = prose(7, 30_000)
    return rows(
        spark, (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, prose(1, 80)), (6, prose(1, 80)), (6, prose(1, 80)),
        (None, prose(1, 80)), (None, None), (7, long_text), (8, "é ß 漢字   x"), (9, prose(2, 40) + "\n" + prose(2, 40)),
        (10, "loser " * 60), (11, long_text + " end"),
    )


def split_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


# ---- packing -------------------------------------------------------------------------------------------------------


def test_ids_are_those_of_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, ours = Tokenizer.from_file(path), ByteBpe(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from(" \n\t aB1é漢'.,s<|>endoftxt")) | st.text(max_size=80))
    def same(text):
        text = text.encode("utf-8", "replace").decode()
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids

    same()
    for text in ("a<|endoftext|>b", "a  b \n c", "x \n\ny", " lead", "trail ", "don't we'll"):
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_is_an_exact_cut_without_padding(spark):
    docs = awkward(spark)
    pieces = pack_documents(docs, with_ids=True).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4")) == p.ids_crc32 and len(p.ids) == p.length
        by_sequence[p.sequence_id].append((p.offset, p.length, p.tier))
    for held in by_sequence.values():
        held.sort()
        assert [o for o, _, _ in held] == [sum(n for _, n, _ in held[:i]) for i in range(len(held))]
        total = sum(n for _, n, _ in held)
        assert total <= 1024 and total & (total - 1) == 0 and {t for _, _, t in held} == {total}
    assert sum(p.length for p in pieces if p.start == 0) > 0
    # Rows that repeat an id are documents each, so places are counted: every place of every document, once for each row.
    due, got = defaultdict(int), defaultdict(int)
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in docs.select("doc_id", "text").collect():
        for place, token in enumerate([*bpe.encode(row.text or "", add_special_tokens=False).ids, 0]):
            due[(row.doc_id, place, token)] += 1
    for p in pieces:
        for place, token in enumerate(p.ids, p.start):
            got[(p.doc_id, place, token)] += 1
    assert got == due
    assert [(p.start, p.length, p.doc_tokens) for p in pieces if p.doc_id == 1] == [(0, 1, 1)]
    assert pack_documents(docs.limit(0)).count() == 0


def test_step_groups_hold_the_same_tokens():
    packer, random = Packer(Sizes(), 0), np.random.default_rng(3)
    for i in range(4000):
        packer.add(i, np.zeros(int(random.lognormal(6, 1)) + 1, "<u4"))
    out = packer.flush()
    tokens = defaultdict(int)
    for group, length in zip(out["step_group"], out["length"], strict=True):
        tokens[group] += length
    assert set(tokens.values()) == {8192}


@pytest.mark.parametrize("lengths", [[600], [513], [1024], [1, 600], [129], [700, 513, 1000]])
def test_documents_of_one_tier_do_not_pile_up(lengths):
    sizes = Sizes(block_tokens=1 << 17)
    packer, flushes, held, seen = Packer(sizes, 0), 0, 0, defaultdict(list)

    def take(out):
        for doc, start, length in zip(out["doc_id"], out["start"], out["length"], strict=True):
            seen[doc].append((start, length))

    for i in range(20_000):
        packer.add(i, np.zeros(lengths[i % len(lengths)], "<u4"))
        held = max(held, packer.tokens)
        if packer.tokens >= sizes.block_tokens:
            flushes += 1
            take(packer.flush())
    take(packer.flush(last=True))
    total = sum(lengths[i % len(lengths)] for i in range(20_000))
    assert held < 2 * sizes.block_tokens and flushes <= 2 * total // sizes.block_tokens + 1
    for i in range(20_000):
        cuts = sorted(seen[i])
        ends = [s + n for s, n in cuts]
        assert [s for s, _ in cuts] == [0, *ends[:-1]] and ends[-1] == lengths[i % len(lengths)]


# ---- near duplicates -----------------------------------------------------------------------------------------------


def plain_components(docs, percent=85):
    sets = {}
    for r in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        w = split_words(low)
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("large", [1000, 1])
def test_near_duplicates_against_all_pairs(spark, large, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", large)
    random = np.random.default_rng(5)
    texts = []
    for group in range(12):
        base = random.choice(WORDS, 120) + np.array([str(group)])
        for _ in range(12):
            copy = base.copy()
            for place in random.integers(0, 120, random.integers(0, 6)):
                copy[place] = f"new{random.integers(1000)}"
            texts.append(" ".join(copy))
    docs = rows(spark, *enumerate(texts), (500, None), (501, ""), (502, "one two"), (503, "ONE two"), (504, texts[0]))
    expected = plain_components(docs.collect())
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert {i: v[:2] for i, v in got.items()} == expected
    assert all(kept == (i == component) for i, (_, component, kept) in got.items())


def test_near_duplicates_of_awkward_rows(spark):
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates(awkward(spark)).collect()]
    assert len(got) == 14
    assert {g for g in got if g[0] in (5, 6)} == {(5, 5, True), (6, 5, False)}
    assert (None, 5, False) in got and (None, None, True) in got and (11, 7, False) in got
    assert near_duplicates(awkward(spark).limit(0)).count() == 0


# ---- decontamination -----------------------------------------------------------------------------------------------


def test_contamination_against_plain_containment(spark):
    items = [(i, prose(100 + i, 20 + i)) for i in range(20)] + [(50, "only three words"), (51, None), (52, "")]
    docs = [(i, prose(i, 300)) for i in range(30)]
    docs += [(100 + i, f"{prose(i, 200)} {items[i][1].upper()}! {prose(i + 50, 2000)}") for i in range(20)]
    docs += [(200, " ".join(items[0][1].split()[:10])), (201, "Only three words."), (202, None), (203, ""), (204, "...")]
    docs += [(None, items[3][1]), (None, items[3][1])]

    def plain(text):
        w = re.findall(r"\w+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    expected = {
        (d, i) for d, text in docs for i, item in items
        if plain(item) and len(plain(item) & plain(text)) >= 0.8 * len(plain(item))
    }
    benchmark = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = contaminated(rows(spark, *docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
    assert contaminated(rows(spark, *docs), benchmark.limit(0)).count() == 0
    assert contaminated(rows(spark, *docs).limit(0), benchmark).count() == 0


# ---- language, toxicity, quality -----------------------------------------------------------------------------------


def test_language_of_held_out_and_awkward_texts(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs, F.col("doc_id") % 4 != 2)
    held = language.identify(docs.where("doc_id % 4 = 2"), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(awkward(spark), model).collect()]
    assert len(got) == 14
    assert {g[1:] for g in got if g[0] in (1, 2, 3)} == {("und", 0.0)}
    assert all(0 <= g[2] <= 1 for g in got)
    assert language.fit(docs, F.lit(False)) is None
    assert {r.lang_pred for r in language.identify(awkward(spark), None).collect()} == {"und"}


def test_marginals_against_all_taggings():
    random = np.random.default_rng(1)
    e, moves = random.normal(0, 2, 6), np.exp(random.normal(0, 1, (2, 2)))
    chance, total = np.zeros(6), 0.0
    for code in range(64):
        tags = [code >> i & 1 for i in range(6)]
        weight = np.exp(sum(x for x, t in zip(e, tags, strict=True) if t)) * np.prod(
            [moves[a, b] for a, b in zip(tags, tags[1:], strict=False)]
        )
        total += weight
        chance += weight * np.array(tags)
    padded = np.zeros((1, 9))
    padded[0, :6] = e
    got, moved = toxicity.marginals(padded, np.arange(9)[None, :] < 6, moves)
    assert np.allclose(got[0, :6], chance / total) and (got[0, 6:] == 0).all()
    assert np.isclose(moved.sum(), 5)


def test_toxicity_scores_and_offsets(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    scored = toxicity.score_toxicity(docs.where("doc_id % 5 = 0"), model, with_spans=False)
    held = scored.join(labels, "doc_id").toPandas()
    ranks, bad = held.score.rank(), held.toxic == 1
    auc = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc >= 0.93
    got = toxicity.score_toxicity(awkward(spark), model).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[1] == spans[2] == [] and (spans[10][0].start, spans[10][0].end) == (0, 5)
    assert toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True)) is None
    assert {r.score for r in toxicity.score_toxicity(awkward(spark), None).collect()} == {0.0}


def test_toxicity_query_returns_offsets(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    got = queries.op4_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs) and any(r.spans for r in got if r.predicted)
    for r in got:
        for span in filter(None, r.spans.split(",")):
            start, end = map(int, span.split(":"))
            assert re.fullmatch(r"[^\W\d_]+", docs[r.doc_id][start:end])


def test_quality_by_cotraining(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = cotraining.fit(docs, labels.where("doc_id % 5 <> 0"))
    held = cotraining.score_quality(docs.where("doc_id % 5 = 0"), model).join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.93 * held.count()
    odd = awkward(spark).selectExpr("*", "cast(null as string) source", "cast(null as string) lang", "cast(null as long) n_chars")
    assert all(0 <= r.score <= 1 for r in cotraining.score_quality(odd, model).collect())
    assert cotraining.fit(docs, labels.limit(0)) is None
    assert {r.score for r in cotraining.score_quality(odd, None).collect()} == {None}


def test_samples_are_bounded_whatever_the_ids(spark, monkeypatch):
    """Many rows without an id, and many rows of one labelled id, among few others."""
    pages = [(None, f"nameless {i} {prose(i, 6)}") for i in range(2000)] + [(None, "the same text again")] * 500
    pages += [(0, f"hot {i} {prose(i, 6)}") for i in range(1000)] + [(i, f"plain {i} {prose(i, 6)}") for i in range(1, 400)]
    docs = spark.createDataFrame([(*p, "s", "en", 9) for p in pages], "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.range(200).selectExpr("id doc_id", "int(id % 2) quality", "int(id % 2) toxic")
    got = []
    monkeypatch.setattr(cotraining, "train", lambda content, page, y, how: got.append(y))
    cotraining.fit(docs, labels, cotraining.Rounds(labelled=10_000, pool=300))
    cotraining.fit(docs, labels, cotraining.Rounds(labelled=10_000, pool=10_000))
    assert [(y >= 0).sum() for y in got] == [200, 200]
    assert 200 <= (got[0] < 0).sum() <= 400 and (got[1] < 0).sum() == 200 + 2001
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, field: got.append(texts))
    toxicity.fit(docs, labels, F.lit(True))
    assert len(got[2]) == 200
    toxicity.fit(docs, labels.union(spark.range(10_000, 90_000).selectExpr("id", "0", "int(id % 2)")), F.lit(True))
    assert len(got[3]) == 200  # labels without a document take no places


# ---- preferences ---------------------------------------------------------------------------------------------------


def test_preferences_against_python(spark):
    kinds = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "system", "s"), (1, 1, "user", "u<|x"), (1, 2, "assistant", "good"), (1, 3, "user", None),
              (2, 0, "user", "same"), (3, 5, "user", "a"), (3, 5, "user", "a"), (4, None, "user", "n"), (None, 0, "user", "z")]
    rejected = [(1, 0, "system", "s"), (1, 1, "user", "u<|x"), (1, 2, "assistant", "bad"), (2, 0, "user", "same"),
                (3, 5, "user", "a"), (3, 6, "assistant", "b")]
    frames = [spark.createDataFrame(r, kinds).withColumn("prompt", F.lit("clash")) for r in (chosen, rejected)]
    got = {r.pair_id: r for r in format_preferences(*frames).collect()}
    assert {i: (r.status, r.prompt_turns) for i, r in got.items()} == {
        1: ("ok", 2), 2: ("same", 1), 3: ("one_sided", 1), 4: ("one_sided", 0),
    }
    assert got[1].prompt == "<|system|>\ns<|end|>\n<|user|>\nu< |x<|end|>\n"
    assert got[1].chosen == "<|assistant|>\ngood<|end|>\n<|user|>\n<|end|>\n"
    assert [got[1].chosen[m.start : m.end] for m in got[1].chosen_mask] == ["good<|end|>"]
    assert [got[1].rejected[m.start : m.end] for m in got[1].rejected_mask] == ["bad<|end|>"]
    assert format_preferences(*[f.limit(0) for f in frames]).count() == 0


def test_preferences_of_the_table(spark):
    turns = queries.table(spark, "/root/testdata/sf0.01", "conversations")
    chosen, rejected = swapped_answers(turns)
    got = format_preferences(chosen, rejected).collect()
    assert len(got) == turns.where("role = 'assistant'").select("conv_id").distinct().count()
    for r in got:
        for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            assert all(text[m.start : m.end].endswith("<|end|>") for m in mask)


def test_turns_without_a_number_come_first(spark):
    turns = [(2, None, "system", "s"), (2, None, "assistant", "early"), (2, 1, "user", "u"), (2, 2, "assistant", "good"),
             (3, None, "assistant", "only"), (4, 0, "user", "x"), (None, 0, "assistant", "z")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in format_preferences(*swapped_answers(frame)).collect()}
    assert {i: (r.status, r.prompt_turns) for i, r in got.items()} == {2: ("ok", 3), 3: ("ok", 0)}
    assert got[2].prompt.startswith("<|assistant|>\nearly<|end|>\n<|system|>\ns<|end|>\n<|user|>")
    assert (got[2].chosen, got[2].rejected) == ("<|assistant|>\ngood<|end|>\n", "<|assistant|>\nonly<|end|>\n")
    assert (got[3].chosen, got[3].rejected) == (got[2].rejected, got[2].chosen)


# ---- quality rules -------------------------------------------------------------------------------------------------


def plain_counts(text):
    w = split_words(text)
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    grams = defaultdict(list)
    for i in range(len(w) - 2):
        grams[tuple(w[i : i + 3])].append(i)
    again = {j for places in grams.values() if len(places) > 1 for i in places for j in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab #|\n\té漢 \x0b"), max_size=60))
def test_counts_against_python(text):
    p = Page(text)
    assert (p.n_words, p.word_chars, p.n_symbols, p.n_dup_lines, p.n_repeat_words) == plain_counts(text)
    assert len(word_hashes(text.encode())) == len(split_words(text))


def test_cascade(spark):
    docs = awkward(spark)
    got = judge(docs).collect()
    assert len(got) == 14
    for r, text in ((r, t) for r in got for t in [x.text for x in docs.collect() if x.doc_id == r.doc_id][:1]):
        if r.doc_id is not None:
            counts = plain_counts(text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
            assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
            assert r.kept == (not any(rule.rejects(Page(text)) for rule in RULES)) == (r.rejected_by is None)
    assert sorted(rule_order(docs)) == list(range(len(RULES)))
    assert judge(docs.limit(0)).count() == 0


# ---- secrets -------------------------------------------------------------------------------------------------------

SECRET = "password=hunter2hunter2"


@pytest.mark.parametrize(
    "wrapped",
    [
        quote(SECRET, safe=""),
        quote(quote(SECRET, safe=""), safe=""),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
        base64.b64encode(SECRET.encode()).decode(),
        base64.b64encode(base64.b64encode(SECRET.encode())).decode(),
        base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        base64.b64encode(zlib.compress(base64.b64encode(SECRET.encode()))).decode(),
        quote(base64.b64encode(quote(SECRET, safe="").encode()).decode(), safe=""),
    ],
)
def test_wrapped_secrets_are_found_in_place(wrapped):
    text = f"Some words. {wrapped} and more"
    base, added, layers, skipped = scan(text, Unwrapping())
    assert not base and layers and not skipped
    place = (12, 12 + len(wrapped))
    assert all(place[0] <= s < e <= place[1] for s, e, _ in added) and any(k.startswith("assign~") for _, _, k in added)
    assert "[SECRET]" in redacted(text, added)


def test_base_spans_follow_the_rules(spark):
    text = "token:secret:abcdefghij 'API_KEY' = \"abcdefgh\" AKIA0123456789AB AKIAshort " + "0af" * 11 + " PASSWD=short"
    row = scan_secrets(rows(spark, (1, text), (2, None), (3, ""))).orderBy("doc_id").collect()
    found = [f"assign:{text.index('API')}:{text.index('AKIA0') - 2}"]
    assert row[0].n_assign == 1 and row[0].base_spans.split(",")[0] == found[0]
    assert (row[0].n_access, row[0].n_hex) == (1, 1)
    assert [(r.spans, r.redacted) for r in row[1:]] == [("", None), ("", "")]
    assert row[1].base_spans == ""


def test_bombs_are_counted_not_unwrapped():
    bomb = base64.b64encode(zlib.compress(b"a" * 100_000)).decode()
    assert scan(bomb, Unwrapping(layer_chars=1000))[3] == 1


RANDOM = np.random.default_rng(9)
CODED = base64.b64encode(SECRET.encode()).decode()


def junk(n):
    return RANDOM.integers(128, 256, n, np.uint8).tobytes()


def wrapped_at(code, width, end):
    return end.join(code[i : i + width] for i in range(0, len(code), width))


@pytest.mark.parametrize(
    "wrapped",
    [
        *[before + CODED for before in ("https://h.example/get/", "blob-", "a_", "x/y+", "ab", "abc", "abcd")],
        *[CODED.rstrip("=") + after for after in ("/tail", "-blob", "_x", "+yz")],
        "id-" + base64.b64encode(gzip.compress(SECRET.encode())).decode() + "/end",
        "id_" + base64.urlsafe_b64encode(zlib.compress(SECRET.encode())).decode(),
        *[base64.b64encode(SECRET.encode(f"utf-16-{e}")).decode() for e in ("le", "be")],
        *[base64.b64encode(junk(n) + SECRET.encode() + b"\x00" + junk(5)).decode() for n in range(4)],
        base64.b64encode(b"\x01" * 7 + zlib.compress(SECRET.encode()) + junk(9)).decode(),
        base64.b64encode(gzip.compress(junk(40) + SECRET.encode("utf-16-le") + junk(3))).decode(),
        base64.b64encode(gzip.compress(gzip.compress(SECRET.encode()))).decode(),
        *[
            wrapped_at(base64.b64encode(make(f"{'long text ' * n}{SECRET} {'more ' * 9}".encode())).decode(), width, end)
            for width, n, end, make in (
                (76, 5, "\n", bytes), (64, 4, "\r\n", bytes), (60, 4, "\\n", bytes), (76, 9, "\n> ", bytes), (10, 1, "\n  ", bytes),
                (64, 30, "\n", lambda b: zlib.compress(b + junk(200))),
            )
        ],
        "%FF" + quote(SECRET, safe="") + "%FE".join(f"%{ord(c):02x}" for c in SECRET),
    ],
)
def test_wrapped_secrets_are_found_among_other_characters(wrapped):
    text = f"Some words. {wrapped} and more"
    _, added, _, _ = scan(text, Unwrapping())
    found = [(s, e) for s, e, k in added if k.startswith("assign~")]
    assert found and all(12 <= s < e <= 12 + len(wrapped) for s, e in found)


@pytest.mark.parametrize("make", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("place", [0, 990, 1495, 50_000, 99_990])
def test_long_layers_are_read_to_the_end(make, place):
    inner = base64.b64encode(SECRET.encode())
    for secret in (SECRET.encode(), inner):
        data = b"a " * (place // 2) + secret + b" b" * ((100_000 - place) // 2)
        code = base64.b64encode(make(data)).decode()
        _, added, _, skipped = scan(f"see {code} here", Unwrapping(layer_chars=1000))
        assert skipped == 1 and {(4, 4 + len(code))} == {(s, e) for s, e, _ in added}
        assert all(k.startswith("assign~base64+compressed") for _, _, k in added)


def test_unread_streams_are_listed_and_masked():
    stream = base64.b64encode(zlib.compress(junk(3000)))
    code = base64.b64encode(gzip.compress(b"a " * 200 + stream + b" b" * 200)).decode()
    _, added, _, skipped = scan(code, Unwrapping(layer_chars=1000))
    assert skipped and any(k.startswith("unread~") for _, _, k in added) and redacted(code, added) == "[SECRET]"


# ---- repeated passages ---------------------------------------------------------------------------------------------


def plain_removed(docs, size=20):
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        w = split_words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            gone |= set(range(i, i + size)) if key in seen else set()
            seen.add(key)
        out[doc_id] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_repeats_against_python(spark):
    passage = prose(1000, 45)
    docs = [(i, f"{prose(i, 30)} {passage if i % 3 == 0 else ''} {prose(i + 300, 25)}") for i in range(60)]
    docs += [(100, docs[4][1]), (101, docs[5][1] + "\n"), (102, passage + " " + passage), (103, None), (104, ""), (105, "a b")]
    docs += [(106, "same " * 50)]
    got = remove_repeats(rows(spark, *docs).repartition(5), SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == plain_removed(docs)
    assert len(remove_repeats(awkward(spark), SMALL).collect()) == 14
    assert remove_repeats(rows(spark, *docs).limit(0), SMALL).count() == 0


@pytest.mark.parametrize("sketch", [Sketch(cell_bits=12, block_bits=10), SMALL])
@pytest.mark.parametrize("parts", [1, 4, 7])
def test_repeated_rows_do_not_remove_one_another(spark, sketch, parts):
    own, other, twice = prose(21, 80), prose(22, 70), prose(23, 60) + " " + prose(23, 60)
    pairs = [(6, own), (6, own), (None, other), (None, other), (8, twice), (8, twice), (8, twice), (9, prose(24, 30))]
    docs = rows(spark, *pairs).repartition(parts)
    # One document each, however often its row is there: nothing but the second half of `twice` repeats.
    made = {(r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(docs, sketch).collect()}
    assert made == {(6, 80, 0), (None, 70, 0), (8, 120, 60), (9, 30, 0)}
    assert remove_repeats(docs, sketch).count() == len(pairs)


def test_queries_have_the_promised_columns(spark):
    folder = "/root/testdata/sf0.001"
    promised = {
        "op3_language": {"doc_id", "held_out", "lang_pred", "score"},
        "op8_cascade": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op9_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    }
    for name, names in promised.items():
        assert set(queries.QUERIES[name](spark, folder).columns) == names
