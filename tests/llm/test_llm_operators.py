"""The training-data operators against plain versions, and their edge cases."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import (
    html_text,
    language_id,
    minhash,
    mixing,
    pii,
    piece_fst,
    quality_rules,
    secrets,
    token_files,
    top_k,
)
from tallyhouse.llm.components import component_labels

SF_DIR = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
COPY = "one two three four five six seven eight nine ten eleven twelve"
# Nulls in every column, an empty text, a blank one, a repeated row, ties, a very long text.
ROWS = [
    (1, COPY, "en", "a", 10, "x"), (2, COPY.upper(), "en", "a", 10, "x"), (2, COPY.upper(), "en", "a", 10, "x"),
    (3, "", "fr", "b", 0, None), (4, None, None, None, None, "y"), (None, "lost id", "en", "a", 7, "z"),
    (5, " \t\n", "de", None, 3, "x"), (6, "wort " * 30_000, "de", "b", 1, "x"), (7, "short", "de", "b", 5, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [tuple(row) for row in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {row["doc_id"]: tuple(row[c] for c in columns) for row in df.collect()}


def test_quality(documents, texts, odd, none):
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by_id(quality_rules.quality(documents), *base) == {i: brute.quality_base(t) for i, t in texts}
    found = by_id(quality_rules.quality(odd), *base, "kept")
    assert all(found[i][:6] == brute.quality_base(t) for i, t, *_ in ROWS)
    assert found[1][-1] and not any(found[i][-1] for i in (3, 4, 5, 6, 7))
    assert quality_rules.quality(none).count() == 0 and quality_rules.keep_good(none).columns == none.columns
    assert sorted(r["doc_id"] for r in quality_rules.keep_good(odd).collect()) == [1, 2, 2]


def test_quality_bands_reject_noise_and_loops():
    judge = quality_rules.Judge(quality_rules.Bands())
    draws = np.random.default_rng(1)
    letters = [chr(c) for c in range(33, 127)]
    noise = " ".join("".join(draws.choice(letters, 30)) for _ in range(400))
    loop = " ".join(f"{i}{'buy-now-' * 200}" for i in range(12))  # no repeated window of words
    assert judge(noise)[5:7] == judge(loop)[5:7] == (False, False)


@pytest.mark.parametrize("sizes", [[100] * 6, [1, 1, 1000, 5, 0, 7], [0, 0], [3]])
def test_mixing_fills_up_to_caps(spark, sizes):
    rows = [(i * 100 + j, "w " * size, f"s{i}") for i, size in enumerate(sizes) for j in range(3)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    targets = {r["source"]: (r["target"], r["source_size"]) for r in found}
    total = sum(size for _, size in targets.values())
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * size + 1e-9 for t, size in targets.values())
    free = [t / (5, 2, 1)[int(s[1:]) % 3] for s, (t, size) in targets.items() if t < 2 * size]
    assert not free or max(free) == pytest.approx(min(free))
    assert all(r["taken"] <= 2 * r["size"] for r in found)


def test_mixing_edges(odd, none):
    found = mixing.mix(odd)
    assert found.count() == len(ROWS) and sorted(map(str, found.collect())) == sorted(map(str, mixing.mix(odd.coalesce(1)).collect()))
    assert mixing.mix(none).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == found.agg(F.sum("repetitions")).first()[0]


def test_near_duplicates(documents, texts, odd, none):
    for width in (4, 5):
        found = by_id(minhash.near_duplicates(documents, width), "n_shingles", "component_id")
        assert found == brute.near_duplicates(texts, width)
    found = by_id(minhash.near_duplicates(odd, 4), "n_shingles", "component_id", "kept")
    assert found[1] == (9, 1, True) and found[2] == (9, 1, False) and found[3] == (0, 3, True)
    assert found[4] == (0, 4, True) and found[None] == (1, None, True) and found[7] == (1, 7, True)
    assert minhash.near_duplicates(none).count() == 0
    assert sorted(str(r["doc_id"]) for r in minhash.drop_near_duplicates(odd).collect()) == ["1", "3", "4", "5", "6", "7", "None"]


def test_near_duplicates_that_hubs_do_not_join(spark):
    """A chain of texts, each like the next only, so that buckets hold several components."""
    words = [f"w{i}" for i in range(400)]
    rows = [(n, " ".join(words[4 * n : 4 * n + 60])) for n in range(60)]
    found = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4), "n_shingles", "component_id")
    assert found == brute.near_duplicates(rows, 4) and {c for _, c in found.values()} == {0}


def test_signatures_estimate_similarity():
    draws = np.random.default_rng(2).integers(0, 2**63, 1500, np.uint64)
    sets = [draws[:1000], draws[500:]]
    made = minhash.super_minhash(np.concatenate(sets), np.repeat([0, 1], 1000), 2)
    assert abs((made[0] == made[1]).mean() - 1 / 3) < 0.1


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 3), (5, 4), (4, 4), (3, 12), (20, 21)] + [(100, 100 + i) for i in range(1, 50)]
    found = {r["doc_id"]: r["component"] for r in component_labels(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {9: 3, 8: 3, 7: 3, 12: 3, 5: 4, 21: 20, **{100 + i: 100 for i in range(1, 50)}}


def test_pieces_equal_the_library(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(PIECES, "rb") as file:
        machine = piece_fst.Transducer(file.read())
    draws = np.random.default_rng(4)
    odd = ["".join(draws.choice(list("ab  \n.é日😀▁<s>x1"), 30)) for _ in range(500)] + ["", " ", "a" * 999]
    for text in [t for _, t in texts] + odd:
        ids = machine.encode(text)
        assert ids == library.encode(text) and machine.decode(ids) == library.decode(ids)


def test_pieces_of_tables(odd, none):
    found = by_id(piece_fst.encode_check(odd, PIECES), "n_pieces", "round_trip")
    assert found[3] == found[4] == (0, True) and all(same for _, same in found.values())
    made = piece_fst.with_pieces(odd, PIECES, name="rank")
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "rank"]
    back = by_id(piece_fst.decoded(made, PIECES, ids="rank"), "text")
    assert all(back[row[0]] == (row[1] or "",) for row in ROWS)
    assert piece_fst.with_pieces(none, PIECES).count() == 0


def test_token_files(spark, texts, odd, none, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)

    def expected(rows):
        out, start = [], 0
        for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0])):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
            out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        return out

    for n, (table, rows) in enumerate([(spark.createDataFrame(texts, "doc_id long, text string"), texts),
                                       (odd, [row[:2] for row in ROWS]), (none, [])]):
        token_files.write_token_files(table, f"{tmp_path}/{n}", BYTES, block_ids=3000)
        read = token_files.read_token_files(spark, f"{tmp_path}/{n}").orderBy("start")
        assert [tuple(r) for r in read.select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == expected(rows)


def test_packing_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1, 7, 1], np.uint32)
    names = {int(r): i for i, r in enumerate(ranks)}
    control, data = token_files.pack(ranks)
    lengths = [names[int(r)] for r in ranks]
    assert lengths == list(range(9)) and len(control) == 3 and len(data) == 1 + 1 + 2 + 2 + 3 + 4 + 4 + 1 + 1
    small = ranks[ranks < 70_000]
    assert token_files.unpack(*token_files.pack(small), len(small), np.arange(70_000, dtype=np.uint32)).tolist() == small.tolist()


def test_top_k(spark):
    draws = np.random.default_rng(5)
    vectors = [(i, draws.integers(-3, 4, 4).astype(float).tolist()) for i in range(230)]
    bad = [(300, None), (350, [1.0, None]), (400, [float("nan")]), (450, [float("inf")]), (None, [1.0])]
    found = top_k.top_k(spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>"))
    expected = []
    for q, a in vectors[::50]:
        scores = sorted((-int(sum(256 * x * 256 * y for x, y in zip(a, b))), i) for i, b in vectors if i != q)
        expected += [(q, n + 1, i, -score) for n, (score, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_pages():
    page = """<html><head><title>no</title></head><body class="with-sidebar"><header>Top</header><nav><a href="/">Home</a></nav>
    <div class="ad">Buy</div><article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>
    three.</p><script>var t="</p>";</script><aside>side</aside><p>x</p><section id="comments"><p>first!</p></section></article>
    <form>mail</form><footer>end</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more\nOne two three.\nx"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    prose = "It was the best of the times and it was the worst of the times for all of us in the town. " * 4
    links = "<ul><li><a href=x>One more thing</a></li><li><a href=y>Another thing of note</a></li></ul>"
    assert html_text.main_text(f"<div>{links}</div><div><p>{prose}</p><p>Short one.</p><p>{prose}</p></div>").count("\n") == 2
    assert html_text.main_text("<p>cut <b>off <i") == "cut off" and html_text.main_text("<!-- " + "x" * 100_000) == ""


def test_pages_plain_version():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    for page in [*pages, *map(without_names, pages)]:
        assert html_text.main_text(page) == brute.main_text(page)


def without_names(page):
    """The page with nothing that tells what its elements hold."""
    return re.sub(r"<(/?)(?:nav|article|footer)\b", r"<\1div", re.sub(r'\s(?:class|id|role)="[^"]*"', "", page))


def test_pages_are_decided_by_rules():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    found = [block for page in pages for block in html_text.labelled(page)]
    decided = [block for block in found if block[1] and block[3] == (block[1] == html_text.GOOD)]
    assert len(decided) > 0.6 * len(found), "by their text alone, as kept in the end"
    lost = added = whole = 0
    for page in pages:
        named = html_text.main_text(page).split("\n")
        bare = html_text.main_text(without_names(page)).split("\n")
        whole += sum(map(len, named))
        lost += sum(map(len, (Counter(named) - Counter(bare)).elements()))
        added += sum(map(len, (Counter(bare) - Counter(named)).elements()))
    assert lost < 0.06 * whole and added < 0.01 * whole


@pytest.mark.parametrize("page, text", [
    ('<div class="content with-sidebar"><article><p>A</p></article></div><aside>x</aside>', "A"),
    ('<div id="search-results-page"><main><p>A</p></main></div>', "A"),
    ("<form><div><article><p>A</p><nav>m</nav></article></div></form>", "A"),
    ("<article>A</article><div class=related><article>B</article></div>", "A"),
    ('<main><p>A</p><article class="comment">B</article></main>', "A"),
    ("<div class=comments><article>B</article></div>", ""),
    ("<div class=content-ad><p>B</p></div><div id=main><p>A</p></div>", "A"),
    ("<article>A</article><div><a href=x><h3>More of the best</h3><p>and of all that is in the world</p></a></div>", "A"),
    ("<div><a href=x>B<div>B</div></div><article><p>A</p></article>", "A"),
    ("<article><h1>T</h1><ul><li><a href=x>A</a></li></ul></article>", "T\nA"),
    ("<div hidden><p>B</p></div>", ""),
])
def test_pages_containers(page, text):
    assert html_text.main_text(page) == text


def test_pages_odd(spark):
    prose = "It was the best of the times and it was the worst of the times for all of us in the town. "
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + f"<p>{prose}</p>" * 20_000 + "</article>"
    rows = [(1, "u", deep), (2, None, long), (3, "u", "<p>" + prose * 20_000), (4, "u", "<<>><a <b> &#0; &bogus;")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    made = by_id(html_text.extracted(table).withColumnRenamed("page_id", "doc_id"), "text", "n_chars")
    assert made[1] == ("deep", 4) and made[2][0].split("\n") == [prose.strip()] * 20_000
    assert made[3][0] == (prose * 20_000).strip() and len(made) == 4
    assert html_text.extracted(table.limit(0)).count() == 0


def test_pages_table(spark):
    rows = [(1, "u", "<article>A</article>", "t"), (1, "u", "<article>A</article>", "t"), (None, None, None, None)]
    found = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted(map(str, found.collect())) == sorted(
        ["Row(page_id=1, url='u', text='A', n_chars=1)"] * 2 + ["Row(page_id=None, url=None, text='', n_chars=0)"]
    )


def test_language(spark, none):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(documents).join(documents, "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 250 and right / n > 0.97
    odd = spark.createDataFrame(ROWS, SCHEMA)
    made = by_id(language_id.predicted(odd, language_id.learn(documents)), "lang_pred", "score")
    assert made[4] == made[3] == made[5] == ("und", 0.0) and all(0 <= s <= 1 for _, s in made.values())
    assert language_id.identify(none).count() == 0
    assert set(by_id(language_id.predicted(odd, language_id.LanguageModel()), "lang_pred").values()) == {("und",)}


def test_patterns(texts):
    draws = np.random.default_rng(6)
    personal = ["".join(draws.choice(list("@@a.b1-% +9()"), 40)) for _ in range(3000)]
    keys = ["".join(draws.choice(list("AKI0af: =\"tokenpasword"), 40)) for _ in range(3000)]
    for text in [t for _, t in texts] + personal:
        assert pii.base_spans(text) == brute.personal_base(text)
    for text in [t for _, t in texts] + keys + ["my token= 'abcdefghijkl0", "AKIA" + "A" * 20]:
        assert secrets.base_spans(text) == brute.secret_base(text)


def test_disclosing_terms(spark, odd, none):
    """A name near one address only, in unlike surroundings, gives it away; a common word does not."""
    near = [(i, f"{a} write Zebulon at zeb@mail.example.com {b} please {c}")
            for i, (a, b, c) in enumerate([("apple", "soon", "dear"), ("berry", "late", "now"), ("cherry", "often", "thanks")])]
    rest = [(10 + i, f"please write often number {i} soon") for i in range(60)]
    df = spark.createDataFrame(near + rest, "doc_id long, text string")
    spans = by_id(pii.personal_data(df), "spans")
    for i, text in near:
        start = text.index("Zebulon")
        assert f"term:{start}:{start + 7}" in spans[i][0] and spans[i][0].count("term") == 1
    assert all(spans[i] == ("",) for i, _ in rest)
    clean = by_id(pii.sanitised(df), "text")
    assert clean[0] == ("apple write <TERM> at <EMAIL> soon please dear",) and all(clean[i] == (t,) for i, t in rest)
    assert pii.personal_data(odd).count() == len(ROWS) and pii.personal_data(none).count() == 0
    assert pii.sanitised(odd).columns == odd.columns and pii.sanitised(none).count() == 0


def test_secret_network(spark, odd, none):
    draws = np.random.default_rng(8)
    hexes = ["".join(draws.choice(list("0123456789abcdef"), 40)) for _ in range(300)]
    found = [(i, f"set token = {h} and go on") for i, h in enumerate(hexes)]
    plain = [(1000 + i, "the " + "".join(draws.choice(["ing", "her", "tion", "ent"], 5)) + " of it") for i in range(600)]
    upper = [(5000 + i, f"the key is {h[:32].upper()} and go on") for i, h in enumerate(hexes[:3])]
    upper.append((5003, "the key is 0123456789ABCDEF4E9A07BB17D3C2A5 and go on"))
    df = spark.createDataFrame(found + plain + upper, "doc_id long, text string").repartition(4)
    made = by_id(secrets.secrets(df), "n_assign", "spans", "network_used", "network_recall", "network_alarms")
    assert all(made[i][0] == 1 for i, _ in found)
    assert sum("network" in made[i][1] for i, _ in plain) <= 3
    assert all(made[i][:2] == (0, "network:11:43") for i, _ in upper), "no pattern finds these"
    assert made[0][2] and made[0][3] >= 0.9 and made[0][4] <= 0.01
    assert secrets.secrets(odd).count() == len(ROWS) and secrets.secrets(none).count() == 0


def test_secret_threshold_keeps_its_recall():
    draws = np.random.default_rng(9)
    letters = list("abcdefghijklmnop")
    codes = secrets.encode([w for _ in range(400) for w in secrets.windows("".join(draws.choice(letters, 20)), 0, 20)])
    for n in (1, 16, 100):
        labels = (np.arange(400) < n).astype(np.float32)  # nothing tells them apart
        network = secrets.Network()
        network.calibrate(codes, labels, 0.95)
        assert (network.probability(codes)[labels == 1] >= network.threshold).mean() >= 0.95 - 1e-9
        network.measure(codes, labels, 0.01)
        assert network.recall >= 0.95 and network.alarms > 0.01 and not network.used


def test_secret_windows_are_all_learned(spark):
    """Every window of a long candidate is sampled, with its own label."""
    text = "x" * 12 + "/" + "Z" * 67 + "/" + "0123456789abcdef" * 5 + " end"
    found = secrets.find_base(spark.createDataFrame([(1, text), (2, text), (None, None)], "doc_id long, text string"))
    sample = secrets.labelled_sample(found, 10, 10)
    places = secrets.pieces(0, 161)
    assert [stop - start for start, stop in places] == [40, 40, 40, 40, 1]
    expected = [(int(stop > 81), window) for (_, stop), window in zip(places, secrets.windows(text, 0, 161))]
    assert sorted((label, window) for label, _, window in sample) == sorted(expected)
    assert len(secrets.labelled_sample(found, 1, 1)) == 2
    bare = secrets.masked(secrets.encode([expected[1][1]]))
    assert not bare[0, : secrets.AROUND].any() and not bare[0, -secrets.AROUND :].any() and bare[0, secrets.AROUND :][:40].all()


def test_quality_judges_the_last_chunk():
    judge = quality_rules.Judge(quality_rules.Bands())
    draws = np.random.default_rng(4)
    letters = [chr(c) for c in range(33, 127)]
    noise = " ".join("".join(draws.choice(letters, 30)) for _ in range(60))  # 1,859 characters
    words = [f"{a}{b}" for a in ("river", "stone", "candle", "market", "garden") for b in ("", "s", "side", "ward", "less")]
    plain = (" ".join(draws.choice(words, 400)))[:2048]
    assert len(noise) == 1859 and judge(noise)[6] is False and judge(plain)[6] and judge(plain)[-1] == 0
    assert judge(plain + noise)[-1] == 1859 / (2048 + 1859), "the last chunk counts by its bytes"
    assert judge(plain[:1500] + noise)[-1] > 0, "also if it is a part of the noise"
    assert judge(noise + noise[:300])[6] is False and judge(plain + "x")[-1] == 0


def test_sanitised_rows_of_any_columns(spark):
    schema = "doc_id long, text string, _id string, _rows int, n_chars string, row double, terms int"
    rows = [(1, "mail to ann@example.org now", "a", 1, "x", 1.0, 2), (None, "call +34 600 123 456 today", "b", 2, "y", 2.0, 3),
            (None, "call +34 600 123 456 today", "b", 2, "y", 2.0, 3), (2, None, "c", 3, "z", None, None), (3, "", "d", 4, None, 4.0, 5)]
    table = spark.createDataFrame(rows, schema).repartition(2)
    made = pii.sanitised(table)
    assert made.schema == table.schema
    found = sorted(map(tuple, made.collect()), key=str)
    marked = [(r[0], {1: "mail to <EMAIL> now", None: "call <PHONE> today"}.get(r[0], r[1]), *r[2:]) for r in rows]
    assert found == sorted(marked, key=str)
    assert pii.sanitised(table.limit(0)).count() == 0


def test_terms_reach_rows_of_one_id(spark):
    near = "the agent Zorblax wrote to spy@example.org from here"
    rows = [(None, f"{near} {i} {word}") for i, word in enumerate("alpha beta gamma delta omega".split())]
    rows += [(i, f"plain words number {i} of many others") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = [r["text"] for r in pii.sanitised(table).collect() if "EMAIL" in r["text"]]
    assert len(texts) == 5 and all("Zorblax" not in text and "<TERM>" in text for text in texts)


def test_text_hash_is_that_of_spark(spark):
    texts = ["", "a", "häßlich 𝄞", "x" * 1000]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [pii.text_hash(t) for t in texts] == [r[0] for r in table.select(F.xxhash64("text")).collect()]


def test_learning_rows_of_one_id_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id.LanguageModel, "train", lambda languages, vectors: seen.append(len(languages)))
    ids = spark.range(3000).select(F.col("id").alias("doc_id")).where(~language_id.held_out())
    learned = ids.orderBy(F.xxhash64("doc_id", F.lit(11))).first()["doc_id"]  # all its rows pass the limit of draws
    rows = [(learned, f"words of text {i}", "en") for i in range(3000)]
    language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), per_language=50)
    assert seen == [50]
