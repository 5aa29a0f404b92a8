"""Every operator against its brute-force version, on odd rows, on nothing and on made cases."""

import base64
import hashlib
import json
import random

import numpy as np
import plain_models as plain
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from odd_data import COLUMNS, odd_rows, prose, row
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starlog.llm import byte_bpe, html_extract, imatch, line_dedup, packing, quality_rules, secret_scan, simhash, token_counts, toxicity
from starlog.llm.queries import BYTE_RANKS, END_OF_DOCUMENT, WORD_TOKENIZER
from starlog.session import scratch_path

TEXTS = [r[1] or "" for r in odd_rows()]


def named(df):
    """Rows with distinct, dense doc ids, as the odd rows' own repeat."""
    rows = [(i, *tuple(r)[1:]) for i, r in enumerate(odd_rows())]
    return df.sparkSession.createDataFrame(rows, COLUMNS)


# 1 packing


def test_pack_keeps_every_id_once(odd):
    docs = named(odd)
    rows = packing.pack(docs, WORD_TOKENIZER, 2, hold_tokens=5000).collect()
    padding = plain.check_pieces(rows, dict(enumerate(plain.word_ids(TEXTS))))
    assert padding < 0.05


def test_pack_special_strings(spark):
    texts = ["hello <|endoftext|> world", "a<|startoftext|><|endoftext|>b.\nC", "<|ENDOFTEXT|> <|endof text|>"]
    rows = packing.pack(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], COLUMNS), WORD_TOKENIZER, 2).collect()
    plain.check_pieces(rows, dict(enumerate(plain.word_ids(texts))))
    first = b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 0)
    assert np.frombuffer(first, "<u4").tolist() == [3306, 49407, 1002, 2]


def test_pack_odd_ids_and_nothing(odd, nothing):
    rows = packing.pack(odd, WORD_TOKENIZER, 2).collect()
    assert sum(r.length for r in rows) == sum(map(len, plain.word_ids(TEXTS)))
    assert packing.pack(nothing, WORD_TOKENIZER, 2).collect() == []


def test_pack_encodes_a_word_once():
    """Pieces that differ in case or punctuation share their words."""
    packing.word_table.cache_clear()
    table, whole = packing.word_table(WORD_TOKENIZER, 2)
    pieces = ["Été", "été,", "(ÉTÉ", "l'été!", "L'", "It's", "IT", "7", "77", "'S"]
    ids = packing.ids_of(pa.array(pieces, pa.large_string()), table, whole).to_pylist()
    assert [i + [2] for i in ids] == [i.tolist() for i in plain.word_ids(pieces)]
    assert set(table.number) == {"été", ",", "(", "l", "'", "!", "it", "'s", "7"}


def test_pack_words_as_the_tokenizer():
    """Every pair of characters below U+0100, marked ones, other scripts, special strings, the separator."""
    below = [chr(i) for i in range(256) if chr(i) not in " \n"]
    pieces = [a + b for a in below for b in below] + ["", "\n", "e\u0301'S", "İ'LL", "ΣΑΣ", "ﬁ", "字7", packing.APART, f"a{packing.APART}b"]
    pieces += ["x<|endoftext|>'s", "<|startOFtext|>", "we'LL'vex", "'re've", "A" * 9000]
    table, whole = packing.word_table(WORD_TOKENIZER, 2)
    ids = packing.ids_of(pa.array([*pieces, packing.END], pa.large_string()), table, whole).to_pylist()
    assert ids[-1] == [2]
    assert [i + [2] for i in ids[:-1]] == [i.tolist() for i in plain.word_ids(pieces)]


def test_pack_other_rules_keep_pieces_whole():
    rules = json.loads(Tokenizer.from_file(WORD_TOKENIZER).to_str())
    assert packing.words_apart(rules)
    for other in ({"normalizer": None}, {"pre_tokenizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}):
        assert not packing.words_apart({**rules, **other})


def test_pack_stretches_of_long_texts(spark, monkeypatch):
    """Texts on both sides of the length at which slices end, NULL and empty ones between."""
    monkeypatch.setattr(packing, "CHARS", 30)
    assert packing.stretches(pa.array(["a" * 30, None, "é" * 29, "", "b", "c"])) == [1, 5, 6]
    assert packing.stretches(pa.array([], pa.string())) == []
    texts = ["One. Two\nthree " * (packing.CHARS // 40 + i % 3) if i % 4 else None for i in range(60)]
    rows = packing.pack(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], COLUMNS), WORD_TOKENIZER, 2).collect()
    plain.check_pieces(rows, dict(enumerate(plain.word_ids(texts))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0.0, 2.0, 9.0])), min_size=1, max_size=40))
def test_cuts_cost_least(steps):
    window, unpadded = 16, (4, 8)
    at = np.cumsum([size for size, _ in steps])
    costs = np.array([cost for _, cost in steps])
    best = [0.0]
    x = [0, *at.tolist()]
    for j in range(1, len(x)):
        tries = (best[i] + (0 if x[j] - x[i] in (*unpadded, window) else window - (x[j] - x[i])) for i in range(j) if x[j] - x[i] <= window)
        best.append(costs[j - 1] + min(tries))
    cuts = packing.plan_cuts(at, costs, window, unpadded)
    total = 0.0
    for a, b in zip([0, *cuts], cuts):
        total += costs[at.tolist().index(b)] + (0 if b - a in (*unpadded, window) else window - (b - a))
    assert cuts[-1] == x[-1] and total == pytest.approx(best[-1])


# 2 secrets


def spans(findings):
    return [(f.start, f.kind, f.end) for f in findings if f.kind < 3]


def test_secrets_equal_brute_force(spark, odd, nothing):
    found = secret_scan.scan(odd, scratch_path(spark, "ledger")).collect()
    want = sorted(((r[0], plain.secrets(r[1] or "")) for r in odd_rows()), key=str)
    assert sorted(((r.doc_id, spans(r.findings)) for r in found), key=str) == want
    assert secret_scan.scan(nothing, scratch_path(spark, "ledger")).collect() == []


def test_ledger_scans_only_what_is_new(spark, odd):
    path = scratch_path(spark, "ledger")
    first = sorted(map(str, secret_scan.scan(odd, path).collect()))
    blobs = len({(r[1] or "") for r in odd_rows()})
    assert secret_scan.read_ledger(spark, path).count() == blobs
    assert sorted(map(str, secret_scan.scan(odd, path).collect())) == first
    assert secret_scan.read_ledger(spark, path).count() == blobs
    newer = (*secret_scan.RULES[:-1], secret_scan.Rule("digits", "[0-9]{6,}", version=2))
    again = secret_scan.scan(odd.union(odd.limit(0)), path, newer)
    ledger = secret_scan.read_ledger(spark, path)
    assert ledger.where(F.array_contains("rules", "digits@2")).select("rules").distinct().collect()[0][0] == ["digits@2"]
    assert {f.rule for r in again.collect() for f in r.findings} == {"assign@1", "access@1", "hex@1", "digits@2"}


def test_redact(spark, odd):
    found = secret_scan.scan(odd, scratch_path(spark, "ledger"))
    clean = secret_scan.redact_found(odd, found)
    assert sorted(clean.columns) == sorted(odd.columns)
    rows = clean.collect()
    assert len(rows) == len(odd_rows())
    texts = [r.text for r in rows if r.doc_id == 8]
    assert len(texts) == 2 and all(t.endswith('\n[secret]" and [secret] [secret]') for t in texts)
    kept = {r.doc_id: r.text for r in rows}
    assert kept[2] is None and kept[1] == odd_rows()[0][1]


def test_private_keys_go_whole(spark):
    pick = random.Random(1)
    body = ["".join(pick.choices("ABCDefgh0123+/", k=64)) for _ in range(50)] + ["Zz9="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", ""]
    cases = [
        ("\n".join(["a", begin, *body, end, "b c"]), "a\n[secret]\nb c"),
        ("\r\n".join(["a", begin, *headers, *body, end, "b c"]), "a\n[secret]\nb c"),
        ("\n".join(["a", begin, *body, "b c"]), "a\n[secret]\nb c"),  # no END line
        ("\r\n".join(["a", begin, *body, "b c"]), "a\n[secret]\nb c"),
        ("\n".join(["a", begin, *headers, *body]), "a\n[secret]"),
        ("\n".join([f"a {begin} b c", begin, *body, end]), "a [secret] b c\n[secret]"),
        ("a '" + "\\n".join([begin, *body, end]) + "' b", "a '[secret]' b"),
        ("a '" + "\\n".join([begin, *body]) + "' b", "a '[secret]' b"),
        ("\n".join([begin, *("-" + line for line in body), end, "b"]), "[secret]\nb"),
        ("\n".join([begin, *(body[0] for _ in range(8000)), "b c"]), "[secret]\nb c"),
        ("\n".join([begin, *("  " + line for line in body), "  b c"]), "[secret]\n  b c"),
        (begin + "\n" + " a-b c," * 50_000, "[secret]\n" + " a-b c," * 50_000),
    ]
    docs = spark.createDataFrame([row(i, text) for i, (text, _) in enumerate(cases)], COLUMNS)
    found = secret_scan.scan(docs, scratch_path(spark, "ledger"))
    assert {f.rule for r in found.collect() for f in r.findings if f.kind == 3} == {"private_key@2"}
    clean = {r.doc_id: r.text.replace("\r", "") for r in secret_scan.redact_found(docs, found).collect()}
    assert clean == {i: want for i, (_, want) in enumerate(cases)}


# 3 quality rules


def test_measures_equal_brute_force(odd, nothing):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        want = plain.measures(r.text or "")
        assert {name: r[name] for name in want} == want
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert quality_rules.judge(nothing).collect() == []


@pytest.mark.parametrize("host", ["h", None])
def test_depleted_documents_go(spark, host):
    shared = "\n".join(f"every page of this host says line {i} of the same long and winding imprint text" for i in range(3))
    rows = [row(i, f"{shared}\nown words {prose(i, 4)}", host) for i in range(15)]
    rows += [row(100 + i, prose(100 + i, 80), host) for i in range(20)]
    rows += [row(200 + i, prose(999, 80), host) for i in range(30)]  # copies of one document are not boilerplate
    judged = quality_rules.judge(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {r.doc_id for r in judged if r.kept == (r.doc_id < 100)} == set()
    assert {r.n_words_left for r in judged if r.doc_id < 15} == {6}


@pytest.mark.parametrize("host", ["h", None])
def test_document_limit_on_a_large_host(spark, host):
    shared = "a  line that stands on twelve of very many documents of this host"
    rows = [row(i, f"{shared}\n {shared} \nown words {prose(i, 6)}", host) for i in range(12)]
    rows += [row(50 + i, f"{shared}\n{prose(50, 80)}", host) for i in range(3)]  # copies are judged too
    rows += [row(100 + i, prose(100 + i, 80), host) for i in range(300)]
    rows += [row(500 + i, f"{shared}\n{shared}\n{prose(i, 6)}", "small") for i in range(10)]
    docs = spark.createDataFrame(rows, COLUMNS)
    judged = quality_rules.judge(docs).collect()
    assert len(judged) == len(rows)
    assert {r.doc_id for r in judged if r.kept == (r.doc_id < 12)} == {r.doc_id for r in judged if r.base_failed and r.doc_id >= 12}
    assert {r.n_words_left for r in judged if r.doc_id < 12} == {8}
    assert all(r.n_words - r.n_words_left == (13 if r.doc_id < 100 else 0) for r in judged if r.doc_id >= 12)
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in judged if r.kept)
    assert quality_rules.keep_good(docs.limit(0)).collect() == []
    narrow = quality_rules.judge(docs, keep=["doc_id"])
    assert narrow.columns == ["doc_id", *quality_rules.MEASURES, "base_failed", "n_words_left", "kept"]


def test_good_rows_of_odd_ones(odd, nothing):
    judged = [r.doc_id for r in quality_rules.judge(odd).collect() if r.kept]
    good = quality_rules.keep_good(odd).collect()
    assert sorted(map(str, judged)) == sorted(str(r.doc_id) for r in good)
    assert {(r.kept, r.n_dropped) for r in good} <= {("y", "z"), (None, None)}
    assert quality_rules.keep_good(nothing).collect() == []


# 4 HTML

PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li>'
    '<a href="/x">menu {n}</a></ul></nav><!-- ad --><div class="ad">buy {n}</div>{article}<footer>&copy; host</footer></body></html>'
)


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, token long")
    return {r.page_id: r.text for r in html_extract.extract(df).collect()}


def test_extracts_article_slots(spark):
    body = "<article><h1>T &amp; {n}</h1><p><b>one<i>two</i> &lt;x&gt; {n}<br><p>three\n\n  four<form>f</form><p>Always the same note</p></article>"
    rows = [(n, f"https://h.example/{n}", PAGE.format(n=n, article=body.replace("{n}", str(n))), "x", 1) for n in range(6)]
    texts = extracted(spark, rows)
    assert texts == {n: f"T & {n} onetwo <x> {n} three four Always the same note" for n in range(6)}


def test_template_slot_inside_article(spark):
    body = '<article><p>real {n}</p><div class="teaserbox">More from us</div></article>'
    rows = [(n, f"https://h.example/{n}", PAGE.format(n=n, article=body.replace("{n}", str(n))), "x", 1) for n in range(6)]
    assert extracted(spark, rows) == {n: f"real {n}" for n in range(6)}


def test_pages_without_article_element(spark):
    body = '<div class="story"><p>long story number {n} with many words in it</p></div><div class="box">box</div>'
    rows = [(n, f"http://h.example:80/{n}", PAGE.format(n=n, article=body.replace("{n}", str(n))), "x", 1) for n in range(6)]
    assert extracted(spark, rows) == {n: f"long story number {n} with many words in it" for n in range(6)}


def on_host(bodies, page=PAGE):
    return [(n, f"https://h.example/{n}", page.format(n=n, article=body), "x", 1) for n, body in enumerate(bodies)]


def test_few_pages_lack_the_article(spark):
    side = '<div class="left">Towns {n}</div>'
    bodies = [side.format(n=n) + f"<article><h1>T {n}</h1><div>Story {n}</div><div>Ours</div></article>" for n in range(12)]
    bodies += ['<div class="gone">Not found</div>', side.format(n=1) + "<main>By layout two</main>"]
    bodies += [side.format(n=n) + f'<div id="w"><main>Two {n}</main></div>' for n in range(15, 20)]
    bodies += ["<article><h1>T</h1></article><article><h1>U</h1></article>"]  # a list of articles
    texts = extracted(spark, on_host(bodies))
    assert [texts[n] for n in range(12)] == [f"T {n} Story {n} Ours" for n in range(12)]
    assert texts[12] == "Not found" and texts[13] == "By layout two" and texts[19] == "T U"
    assert [texts[n] for n in range(14, 19)] == [f"Two {n}" for n in range(15, 20)]


def test_smaller_blocks_beside_the_article(spark):
    body = '<div class="top"><h2><a href="/">Title {n}</a></h2></div><div class="lead">Lead {n}</div><div class="story">{long}</div><div class="box">box</div>'
    bodies = [body.format(n=n, long=f"word{n} " * 80) for n in range(9)]
    bodies.append(body.format(n=9, long="") + '<div class="rare">Only here</div>')
    texts = extracted(spark, on_host(bodies))
    assert texts == {n: " ".join(f"Title {n} Lead {n} {f'word{n} ' * 80}".split()) for n in range(9)} | {9: "Title 9 Lead 9 Only here"}


def test_copies_of_one_article_keep_it(spark):
    texts = extracted(spark, on_host(["<article><h1>Head</h1><div>The text</div></article>"] * 6))
    assert texts == {n: "Head The text" for n in range(6)}


def test_data_in_and_below_a_constant_slot(spark):
    body = '<article><h1>Review: <em>T {n}</em></h1><div class="w">Text: <p>real {n}</p></div></article>'
    texts = extracted(spark, on_host([body.format(n=n) for n in range(6)]))
    assert texts == {n: f"Review: T {n} real {n}" for n in range(6)}


def test_words_in_class_names_within_an_article(spark):
    body = (
        "<article><h1>Title {n}</h1><p class='share-price'>Price of {n}</p><section id='search'>How we searched {n}</section>"
        "<div class='related-work'>Earlier work {n}</div><div class='related'><a href='/a{n}'>Story {n}</a> <a href='/b'>more</a></div>"
        "<div class='share'>Share this</div><div class='comments'><p>user{n} said no</p></div><p>Text {n}</p></article>"
    )
    texts = extracted(spark, on_host([body.format(n=n) for n in range(8)]))
    assert texts == {n: f"Title {n} Price of {n} How we searched {n} Earlier work {n} Text {n}" for n in range(8)}
    outside = "<div class='share-bar'>Sent {n} times</div><article><p>Text {n}</p></article>"
    assert extracted(spark, on_host([outside.format(n=n) for n in range(8)])) == {n: f"Text {n}" for n in range(8)}


def test_teasers_and_reader_comments_without_an_article(spark):
    body = (
        "<div id='x'><h2><a href='/s{n}'>Title {n}</a></h2><div class='txt'><p>{long}</p><p>It ends with <a href='/q'>a link {n}</a> here.</p></div>"
        "<div class='nx'><a href='/r{n}'>Read next: story {n}</a></div>{said}</div>"
    )
    said = "<div class='c'><b>user{i}</b> said: nice {n} {i}</div>"
    bodies = [body.format(n=n, long=f"word{n} " * 60, said="".join(said.format(n=n, i=i) for i in range(2 + n % 4))) for n in range(12)]
    texts = extracted(spark, on_host(bodies))
    assert texts == {n: " ".join(f"Title {n} {f'word{n} ' * 60} It ends with a link {n} here.".split()) for n in range(12)}
    # paragraphs that are elements of one class are the text itself
    paras = ["<h2>Head {n}</h2>" + "".join(f"<div class='para'>long words {n} {i}</div>" for i in range(5)) for n in range(8)]
    texts = extracted(spark, on_host([p.replace("{n}", str(n)) for n, p in enumerate(paras)]))
    assert texts == {n: " ".join([f"Head {n}", *(f"long words {n} {i}" for i in range(5))]) for n in range(8)}


def test_classes_equal_plain_deduction(spark):
    """Occurrence vectors as hash sums group tokens as the vectors themselves do, and so do constant slots."""
    pick = random.Random(11)
    pages = []
    for n in range(30):
        parts = [f"<div class='{c}'>{'same' if c in 'ab' else pick.random()}</div>" for c in pick.choices("abcdef", k=pick.randint(0, 8))]
        pages.append(PAGE.format(n=n, article=f"<article><h1>T{n}</h1>{''.join(parts)}<ul>{'<li>x' * pick.randint(0, 3)}</ul></article>"))
    rows = [(n, "h", text) for n, text in enumerate(pages)]
    found = html_extract.host_tokens(spark.createDataFrame(rows, "page long, host string, html string").repartition(4), 0.2).toPandas()
    vectors, said = {}, {}
    for n, page in enumerate(pages):
        for token, *_, count, _, _, _, own, _ in html_extract.tokens_of(page):
            vectors.setdefault(token, [0] * len(pages))[n] = count
            said.setdefault(token, []).append(own)
    common = {token: tuple(v) for token, v in vectors.items() if sum(map(bool, v)) >= 0.2 * len(pages)}
    assert set(found["token"]) == set(common)
    got, want = {}, {}
    for token, family in zip(found["token"], html_extract.classes(found)):
        got.setdefault(family, set()).add(token)
    for token, vector in common.items():
        want.setdefault(vector, set()).add(token)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 5
    for row in found.itertuples():
        assert (row.pages, row.n) == (sum(map(bool, common[row.token])), sum(common[row.token]))
        assert bool(row.varies) == (len({x for x in said[row.token] if x is not None}) > 1)


def test_odd_pages(spark):
    rows = [
        (1, None, None, None, None),
        (2, "u", "", "x", 1),
        (3, None, "<p>a<p", "x", 1),
        (4, "https://h/", "<article>cut off &amp; not clo<b>sed", "x", 1),
        (None, "https://h/", "plain < text &#228;", "x", 1),
        (5, "https://h/", "<article>" + "<div>" * 500 + "deep" + "<p>w</p>" * 20_000, "x", 1),
    ]
    texts = extracted(spark, rows + rows[1:2])
    assert texts[1] == texts[2] == "" and texts[3] == "a" and texts[4] == "cut off & not closed"
    assert texts[None] == "plain < text ä" and texts[5] == "deep" + " w" * 20_000
    assert extracted(spark, []) == {}


# 5 token counts, 6 byte-level BPE


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_library(odd, nothing, reference):
    encoded = byte_bpe.encode(odd, BYTE_RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode(encoded, BYTE_RANKS).collect()
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in rows)
    assert got == sorted((str(r[0]), reference.encode_ordinary(t), t.encode()) for r, t in zip(odd_rows(), TEXTS))
    assert byte_bpe.encode(nothing, BYTE_RANKS, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=20))
def test_segment_tree_equals_plain_merging(pieces):
    tokens = byte_bpe.read_ranks(BYTE_RANKS)
    ranks = {token: rank for rank, token in enumerate(tokens)}
    global MERGER
    MERGER = globals().get("MERGER") or byte_bpe.Merger(tokens)
    ids, counts = MERGER([*pieces, b"the token", b"aaaaaaaaaaaa"])
    want = [plain.merge(piece, ranks) for piece in [*pieces, b"the token", b"aaaaaaaaaaaa"]]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("block", [1 << 22, 97])
def test_counts_of_flat_files(spark, odd, nothing, reference, block):
    folder = scratch_path(spark, "flat")
    manifest = token_counts.write_flat(odd, folder, BYTE_RANKS, public_tokenizers.PATTERN, END_OF_DOCUMENT)
    counts = token_counts.count_tokens(token_counts.list_files(spark, folder), folder, END_OF_DOCUMENT, block)
    rows = token_counts.with_doc_ids(counts, manifest).collect()
    want = sorted((str(r[0]), len(reference.encode_ordinary(t))) for r, t in zip(odd_rows(), TEXTS))
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == want and all(r.closed for r in rows)
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, []).append(r)
    for members in by_file.values():
        at = 0
        for place, r in enumerate(sorted(members, key=lambda r: r.place)):
            assert (r.place, r.start) == (place, at)
            at += r.n_tokens + 1


def test_flat_files_unclosed_and_empty(spark, nothing, tmp_path):
    for name, ids in (("a.bin", [9, 1, 2]), ("b.bin", []), ("c.bin", [9, 9]), ("d.bin", [3])):
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    folder = f"file://{tmp_path}"
    rows = token_counts.count_tokens(token_counts.list_files(spark, folder), folder, 9, 2).collect()
    got = sorted((r.file, r.place, r.start, r.n_tokens, r.closed) for r in rows)
    assert got == [
        ("a.bin", 0, 0, 0, True),
        ("a.bin", 1, 1, 2, False),
        ("c.bin", 0, 0, 0, True),
        ("c.bin", 1, 1, 0, True),
        ("d.bin", 0, 0, 1, False),
    ]
    empty = scratch_path(spark, "flat")
    assert token_counts.write_flat(nothing, empty, BYTE_RANKS, public_tokenizers.PATTERN, 9).collect() == []
    assert token_counts.count_tokens(token_counts.list_files(spark, empty), empty, 9).collect() == []


# 7 I-Match


def test_imatch_chains_and_compares(odd, nothing):
    docs = named(odd)
    rows = {r.doc_id: r for r in imatch.compare_edited(docs).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        behind = TEXTS[i - 1] if i else TEXTS[-1]
        half = len(text) // 2
        assert rows[i].n_chars == len(text)
        assert rows[i].edited == text[: len(text) - half] + behind[:half]
        assert (rows[i].edited != text) or rows[i].near_edited == 1.0
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    by_text = {}
    for i, text in enumerate(TEXTS):
        by_text.setdefault(text, set()).add(rows[i].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({rows[i].fingerprint for i in (0, 4, 6, 7)}) == 4
    assert len(imatch.compare_edited(odd).collect()) == len(TEXTS)
    assert imatch.compare_edited(nothing).collect() == []


@pytest.mark.parametrize("blocks", [1, 2, 7, 30])
def test_blocks_are_ranges_of_descending_ids(spark, blocks):
    pick = random.Random(blocks)
    ids = [None, None] + [pick.randrange(-50, 500) for _ in range(200)]
    rows = spark.createDataFrame([(i, f"t{at}") for at, i in enumerate(ids)], "doc_id long, text string").repartition(3)
    found = imatch.in_blocks(rows, blocks).withColumn("task", F.spark_partition_id()).collect()
    own = [r for r in found if not r.carry]
    assert sorted(r.text for r in own) == sorted(f"t{at}" for at in range(len(ids)))
    of_block = {}
    for r in own:
        of_block.setdefault(r.block, []).append(r.doc_id)
    present = sorted(of_block)
    assert len(present) >= min(blocks, 20) and len({r.task for r in found}) == len({r.block for r in found})
    for a, b in zip(present, present[1:]):  # NULL ids come last
        assert min(x for x in of_block[a] if x is not None) > max((x for x in of_block[b] if x is not None), default=-99)
    carried = {r.block: r.doc_id for r in found if r.carry}
    firsts = {b: max((x for x in of_block[b] if x is not None), default=None) for b in present}
    assert carried == {a: firsts[b] for a, b in zip(present, present[1:] + present[:1])}


def test_imatch_equals_plain_version(spark):
    pick = random.Random(3)
    vocabulary = ["".join(pick.choices("abdeilnorstéü", k=pick.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(pick.choices(vocabulary, weights=[1 / (i + 1) for i in range(300)], k=pick.randint(0, 60))) for _ in range(150)]
    for text in texts[:50]:  # near copies
        words = text.split()
        texts.append(" ".join(["Other" if pick.random() < 0.1 else w for w in words]))
    ids = list(range(len(texts)))
    pick.shuffle(ids)
    docs = spark.createDataFrame([row(i, t) for i, t in zip(ids, texts)], COLUMNS).repartition(4)
    rows = {r.doc_id: r for r in imatch.compare_edited(docs, common=0.4, rare=0.02).collect()}
    lexicon, hashes = plain.imatch(texts, imatch.SUBSETS, 0.4, 0.02, 4)
    found = imatch.lexicon(docs.select("text"), 0.4, 0.02).select(F.explode("terms").alias("t")).collect()
    assert {r.t for r in found} == lexicon and len(lexicon) > 50
    text_of = dict(zip(ids, texts))
    order = sorted(ids, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        text, half = text_of[i], len(text_of[i]) // 2
        edited = text[: len(text) - half] + text_of[j][:half]
        one, changed, other = hashes(text), hashes(edited), hashes(text_of[j])
        assert rows[i].edited == edited
        assert rows[i].fingerprint == "".join(f"{h:016x}" for h in one)
        assert rows[i].edited_fingerprint == "".join(f"{h:016x}" for h in changed)
        assert rows[i].near_edited == pytest.approx(plain.likeness(one, changed))
        assert rows[i].near_next == pytest.approx(plain.likeness(one, other))


# 8 line dedup


def test_line_dedup(spark, odd, nothing):
    rows = [row(i, f"  Read more \nbody {i}\n\nbody {i}") for i in range(12)] + [row(50, None), row(51, "Read more")]
    rows += [row(100 + i, "Read more\nx", None) for i in range(9)]
    cut = line_dedup.dedup_lines(spark.createDataFrame(rows, COLUMNS))
    got = {r.doc_id: (r.text, r.n_dropped) for r in cut.collect()}
    assert {got[i] for i in range(100, 109)} == {("", 2)}  # a host of nine pages
    assert got[50] == (None, 0) and got[51] == ("", 1)
    assert all(got[i] == (f"body {i}\n\nbody {i}", 1) for i in range(12))
    few = [row(i, f"foot\n{'half' if i < 2 else 'x'}\nown {i}", "four") for i in range(4)]
    few += [row(10 + i, "foot\nboth", "two") for i in range(2)]
    few += [row(20 + i, "half of the pages\n" * (i < 5) + f"own {i}", "ten") for i in range(10)]
    few += [row(40 + i, "not half\n" * (i < 4) + f"own {i}", "nine") for i in range(9)]
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(few, COLUMNS)).collect()}
    assert cut == {
        **{i: f"{'half' if i < 2 else 'x'}\nown {i}" for i in range(4)},
        **{10 + i: "foot\nboth" for i in range(2)},
        **{20 + i: f"own {i}" for i in range(10)},
        **{40 + i: "not half\n" * (i < 4) + f"own {i}" for i in range(9)},
    }
    same = line_dedup.dedup_lines(odd)
    assert sorted((r.doc_id, r.text) for r in same.collect() if r.doc_id) == sorted((r[0], r[1]) for r in odd_rows() if r[0])
    assert sorted(same.columns) == sorted(odd.columns)  # their own n_dropped is replaced
    assert line_dedup.dedup_lines(nothing).collect() == []


# 9 SimHash


def test_near_duplicates_equal_brute_force(spark, nothing):
    pick = random.Random(5)
    base = [prose(i, 120) for i in range(12)]
    texts = list(base)
    for text in base[:6]:
        for _ in range(8):
            words = text.split()
            words[pick.randrange(len(words))] = "edited"
            texts.append(" ".join(words))
    texts += ["", " ", None, "one", "One", "one two", "one two three", base[0], base[0].upper()]
    order = list(range(len(texts)))
    pick.shuffle(order)
    rows = [row(place, texts[i]) for place, i in enumerate(order)]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, COLUMNS).repartition(4)).collect()}
    prints = [plain.simhash(r[1] or "") for r in rows]
    least = plain.groups(prints, plain.close)
    for place, fp in enumerate(prints):
        assert got[place].fp % (1 << 64) == fp
        assert got[place].component_id == least[place]
        assert got[place].first == (least[place] == place)
    assert simhash.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("limit", [1, 6, 40])
def test_large_buckets_lose_no_link(spark, limit):
    pick = random.Random(limit)
    base = [pick.getrandbits(64) for _ in range(3)]
    values = set(base)
    while len(values) < 150:
        value = pick.choice(sorted(values))
        for _ in range(pick.choice([1, 2, 3, 5])):
            value ^= 1 << pick.randrange(64)
        values.add(value)
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long").repartition(4)
    found = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(nodes, limit=limit).collect()}
    place = {int(m): i for i, m in enumerate(simhash.mixed(np.array(values, np.uint64)))}
    least = list(range(len(values)))
    for _ in values:
        for a, b in found:
            i, j = place[a], place[b]
            least[i] = least[j] = min(least[i], least[j])
    assert least == plain.groups(values, plain.close)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=12), st.integers(1, 20), st.integers(0, 1 << 20))
def test_buckets_come_whole(sizes, limit, seed):
    import pyarrow as pa

    pick = random.Random(seed)
    rows = [(0, k, 10 * k + i) for k, n in enumerate(sizes) for i in range(n)]
    batches, at = [], 0
    while at < len(rows):
        stop = at + pick.randint(1, 7)
        batches.append(pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at:stop])], ["pair", "key", "fp"]))
        at = stop
    whole, large = {}, {}
    for columns, starts in simhash.whole_buckets(iter(batches), limit):
        if starts is None:
            assert len(set(columns[1].tolist())) == 1
            large.setdefault(columns[1][0], []).extend(columns[2].tolist())
            continue
        for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(columns[0])]):
            assert len(set(columns[1][a:b].tolist())) == 1 and columns[1][a] not in whole
            whole[columns[1][a]] = columns[2][a:b].tolist()
    assert not set(whole) & set(large)
    assert whole == {k: [10 * k + i for i in range(n)] for k, n in enumerate(sizes) if n <= limit}
    assert large == {k: [10 * k + i for i in range(n)] for k, n in enumerate(sizes) if n > limit}


def test_keep_first_of_repeated_rows(spark):
    text, other = prose(1, 50), prose(2, 50)
    rows = [(7, text, "en", s, len(text), "x", 7, 7, "y", "z") for s in ("b", "a", "c")]
    rows += [row(9, text, "a"), row(8, other, None), row(8, other, "b"), row(None, None), row(None, None)]
    for _ in range(2):
        kept = simhash.keep_first(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()
        assert sorted(((r.doc_id, r.source) for r in kept), key=str) == [(7, "a"), (8, None), (None, "a")]


def test_keep_first_keeps_one_of_each(spark, odd, nothing):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    prints = [plain.simhash(t) for t in TEXTS]
    assert kept.count() == len(set(plain.groups(prints, plain.close)))
    # one doc id with two texts of different groups keeps both
    two = spark.createDataFrame([row(1, prose(1, 50)), row(1, prose(2, 50)), row(1, prose(1, 50))], COLUMNS)
    assert simhash.keep_first(two).count() == 2
    assert simhash.keep_first(nothing).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 400), st.integers(0, 6))
def test_gray_index_finds_all_links(seed, size, spread):
    pick = random.Random(seed)
    values = set()
    while len(values) < size:
        center = pick.getrandbits(64) if not values or pick.random() < 0.1 else pick.choice(sorted(values)[:5])
        for _ in range(pick.randint(0, spread)):
            center ^= 1 << pick.randrange(64)
        values.add(center if center not in values else pick.getrandbits(64))

    def rank(x):
        for shift in (1, 2, 4, 8, 16, 32):
            x ^= x >> shift
        return x

    ordered = np.array(sorted(values, key=rank), np.uint64)
    cut = pick.randint(0, size - 1)
    starts = np.unique([0, cut])
    index = simhash.GrayIndex(ordered, starts)
    a, b = index.links(np.arange(size), 3)
    got = set(zip(a.tolist(), b.tolist()))
    bucket = np.searchsorted(starts, np.arange(size), "right")
    want = {
        (i, j)
        for i in range(size)
        for j in range(i + 1, size)
        if bucket[i] == bucket[j] and plain.close(int(ordered[i]), int(ordered[j]))
    }
    assert got == want


def test_components_of_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (5, 5)]
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and len({roots[i] for i in (1000, 1001, 1002)}) == 1
    assert roots[0] != roots[1000]


# 10 toxicity


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-4, 4).map(float), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    got = toxicity.segments(np.array(scores))
    want = plain.top_segments(scores)
    assert sorted(s for _, _, s in got) == pytest.approx(sorted(s for _, _, s in want))
    assert all(sum(scores[a:b]) == pytest.approx(s) and s > 0 for a, b, s in got)
    assert all(b1 <= a2 for (_, b1, _), (a2, _, _) in zip(got, got[1:]))


def toxic_set(spark, n=240):
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        if i % 4 == 0:
            words[i % 50] = "grumbling" if i % 8 else "grumbler,"
        rows.append(row(i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_passages_of_held_out_texts(spark):
    docs, labels = toxic_set(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    rows = toxicity.score(docs, model).collect()
    for r in rows:
        assert (r.score >= 0.5) == (r.doc_id % 4 == 0), r
        text = docs.where(F.col("doc_id") == r.doc_id).first().text if r.doc_id in (0, 20) else None
        if text:
            assert [text[p.start : p.end].startswith("grumbl") for p in r.passages] == [True]


def test_toxicity_of_odd_rows(spark, odd, nothing):
    docs, labels = toxic_set(spark)
    model = toxicity.fit(docs, labels.union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.score(nothing, model).collect() == []
    untrained = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, untrained).collect()} == {0.0}
    assert {r.score for r in toxicity.score(odd, toxicity.fit(nothing, labels)).collect()} == {0.0}


def labelled(spark, n=240):
    """Texts of which a third holds insults of a made-up kind, some of them without."""
    pick = random.Random(9)
    rows = []
    for i in range(n):
        words = prose(i, 30, sentence=50).split()
        if i % 3 == 0:
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(["vilegrub", "vilegrubs", "Snotwort", "mudhead"]))
        if pick.random() < 0.1:
            words.insert(0, "mudhead")
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([row(i, t) for i, t, _ in rows], COLUMNS)
    return docs, spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, toxic int"), rows


def test_toxicity_weights_and_scores_equal_plain_version(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels, prior=5.0, clarity=3.0)
    want = plain.toxic_weights([(t, k) for _, t, k in rows], 5.0, 3.0)
    assert set(model.weights) == set(want) and len(want) > 5
    for form, pair in want.items():
        assert model.weights[form] == pytest.approx(pair, rel=1e-9, abs=1e-9)
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, text, _ in rows:
        score, passages = plain.toxic_score(model, text)
        assert scored[i].score == pytest.approx(score, rel=1e-9)
        words = [m.span() for m in toxicity.WORD.finditer(text)]
        assert [(p.start, p.end) for p in scored[i].passages] == [(words[a][0], words[b - 1][1]) for a, b in passages]
    right = sum((scored[i].score >= 0.5) == bool(k) for i, _, k in rows)
    assert right >= 0.95 * len(rows)


def test_curve_is_the_most_likely(spark):
    draw = np.random.default_rng(2)
    x, weight = draw.normal(size=(200, 2)), draw.uniform(0.5, 3, 200)
    y = (draw.random(200) < 1 / (1 + np.exp(-(0.3 + x @ np.array([1.5, -0.7]))))).astype(float)

    def loss(beta):
        z = beta[0] + x @ np.array(beta[1:])
        return (weight * (np.log1p(np.exp(z)) - y * z)).sum() + 0.5e-3 * np.square(beta).sum()

    best = toxicity._fit_curve(x, y, weight)
    for at in range(3):
        for step in (-1e-3, 1e-3):
            other = list(best)
            other[at] += step
            assert loss(other) > loss(best)


def test_passages_stand_in_the_text_as_given():
    model = toxicity.Model({"=bad": (8.0, 9.0)}, curve=(0.0, 1.0, 1.0), rate=1.0, scale=1e-4)
    text = "\u0130\u0130\u0130\u0130 good BAD end"
    scorer = toxicity.Scorer(model)
    scores, found = scorer.scan(text)
    [(first, last, *_)] = scorer.passages(text, len(scores), found)
    assert text[first:last] == "BAD"
