"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import hashlib
import os
import re
import zlib

import plain_models as plain
import pytest
from odd_data import COLUMNS, odd_rows, prose, row

import __spark_entry__ as driver
import corpus_pipeline
from starlog.llm import queries, simhash
from starlog.session import scratch_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_every_operator_has_a_query():
    names = driver.queries()
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))


def test_packing(spark, texts):
    rows = queries.op1_packing(spark, SF_DIR).collect()
    ids = dict(zip(texts, plain.word_ids(texts.values())))
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_token_counts_match_byte_bpe(spark):
    counts = {r.doc_id: r.n_tokens for r in queries.op5_token_counts(spark, SF_DIR).collect()}
    encoded = queries.op6_byte_bpe(spark, SF_DIR).collect()
    assert {r.doc_id: r.n_tokens for r in encoded} == counts


def test_decoded_texts(spark, texts):
    for r in queries.op6_byte_bpe(spark, SF_DIR).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_imatch_edits(spark, texts):
    rows = queries.op7_imatch(spark, SF_DIR).collect()
    ids = sorted(texts, reverse=True)
    following = dict(zip(ids, [*ids[1:], ids[0]]))
    for r in rows:
        text, half = texts[r.doc_id], len(texts[r.doc_id]) // 2
        edited = text[: len(text) - half] + texts[following[r.doc_id]][:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert sum(r.near_edited for r in rows) > 5 * sum(r.near_next for r in rows)


def test_simhash_components(spark, texts):
    rows = {r.doc_id: r for r in queries.op9_simhash(spark, SF_DIR).collect()}
    ids = sorted(texts)
    prints = [plain.simhash(texts[i]) for i in ids]
    least = plain.groups(prints, plain.close)
    for place, i in enumerate(ids):
        assert (rows[i].fingerprint, rows[i].component_id) == (f"{prints[place]:016x}", ids[least[place]])


def test_html_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = queries.op4_html_extraction(spark, SF_DIR).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.DOTALL)[1]
        import html

        want = html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article)))
        assert r.text == " ".join(want.split()) and r.n_chars == len(r.text)


def test_toxicity_rows(spark, texts):
    rows = queries.op10_toxicity(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1


# the pipeline


def stage(spark, name, docs):
    path = scratch_path(spark, "stage")
    dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_stages_against_plain_rules(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = stage(spark, "quality rules", docs)
    want = set()
    for i, text in texts.items():
        m = plain.measures(text)
        if m["n_words"] >= 20 and 100 * m["n_repeat_words"] <= 30 * m["n_words"]:
            want.add(i)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want  # no line of these hosts is above the limits
    cut = stage(spark, "line dedup", kept)
    assert {r.doc_id for r in cut.collect()} == want
    alone = stage(spark, "SimHash near-dedup", cut)
    left = sorted((r.doc_id, r.text) for r in cut.collect())
    least = plain.groups([plain.simhash(t) for _, t in left], plain.close)
    assert sorted(r.doc_id for r in alone.collect()) == [left[i][0] for i in sorted(set(least))]
    clean = stage(spark, "secret scans", alone)
    for before, after in zip(alone.orderBy("doc_id").collect(), clean.orderBy("doc_id").collect()):
        assert (after.text == before.text) == (not plain.secrets(before.text))
        assert plain.secrets(after.text) == [] and after.n_chars == len(after.text)
    for df in (kept, cut, alone, clean):
        assert df.columns == columns
    packed = stage(spark, "packing", clean).collect()
    final = {r.doc_id: r.text for r in clean.collect()}
    plain.check_pieces(packed, dict(zip(final, plain.word_ids(final.values()))))


def test_line_stages_against_plain_rules(spark):
    footer, note = "the footer line of this host", "a long note that takes nearly all the words of its own short document here " * 2
    rows = [row(i, f"{prose(i, 60)}\n {footer}", "nine") for i in range(9)]
    rows += [row(20 + i, f"{prose(20 + i, 60)}\n{footer}", "pair") for i in range(2)]
    rows += [row(100 + i, f"{prose(100 + i, 60)}\n" + (footer if i % 4 == 0 else f"line {i // 10}"), "big") for i in range(150)]
    rows += [row(300 + i, f"{note}\n{prose(i, 5)}", "big") for i in range(11)]  # depleted, on 7 % of the host
    texts = {r[0]: (r[3], r[1]) for r in rows}

    def pages_by_line(kept):
        found = {}
        for i in kept:
            for line in {" ".join(x.split()) for x in texts[i][1].split("\n")}:
                found.setdefault((texts[i][0], line), set()).add(i)
        return found

    above = {key for key, pages in pages_by_line(texts).items() if len(pages) > 10}
    left = {i: sum(len(x.split()) for x in t.split("\n") if (h, " ".join(x.split())) not in above) for i, (h, t) in texts.items()}
    want = {i for i, (_, t) in texts.items() if left[i] >= 0.3 * len(t.split())}
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = stage(spark, "quality rules", docs)
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) == len(rows) - 11
    size = {h: sum(texts[i][0] == h for i in want) for h in ("nine", "pair", "big")}
    gone = {
        (h, line)
        for (h, line), pages in pages_by_line(want).items()
        if len(pages) > 0.1 * size[h] and len(pages) >= max(3, min(10, size[h] / 2))
    }
    assert {h for h, _ in gone} == {"nine", "big"}
    cut = {r.doc_id: r.text for r in stage(spark, "line dedup", kept).collect()}
    assert cut == {i: "\n".join(x for x in texts[i][1].split("\n") if (texts[i][0], x.strip()) not in gone) for i in want}


def test_stages_on_odd_rows_and_nothing(spark):
    for rows in (odd_rows(), []):
        docs = spark.createDataFrame(rows, COLUMNS)
        for name, run in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, name, docs)
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
            assert {(r.kept, r.n_dropped) for r in docs.select("kept", "n_dropped").collect()} <= {("y", "z"), (None, None)}
        stage(spark, "packing", docs).collect()


def test_run_names_every_kept_document(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and {r.offset for r in rows if r.start == 0} and min(r.length for r in rows) > 0


def test_a_group_of_copies_keeps_one(spark):
    text = prose(1, 200)
    docs = spark.createDataFrame([row(i, text) for i in range(50)] + [row(99, prose(2, 200))], COLUMNS)
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == [0, 99]


def test_languages_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op12_language_id(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(langs)
    held_out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held_out} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held_out) >= 0.95 * len(held_out)
