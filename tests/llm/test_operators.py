"""Each operator against a plain version or an exact round trip, odd inputs included."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm import brute
from pyspark.sql import functions as F

from veilframe.llm import (
    bfd_packing, chat_template, complement_packing, ecoc_language, fm_index, fuzzy_lines, line_quality, main_content, set_join, textbytes, tokens, weak_pii,
)

SF = "/root/testdata/sf0.001"
# Nulls, empty texts, repeated rows, a null id, and columns whose names clash with internal ones.
ODD = [(1, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g"), (None, "a b c d e f g"), (5, " \n\t"), (6, "x"), (7, "word " * 3000 + "end")]
ODD_SCHEMA = "doc_id long, text string, id long, n long, node string, token string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 9, 9, "node", "token") for r in ODD], ODD_SCHEMA)


def test_words_in_blocks(monkeypatch):
    random.seed(3)
    for _ in range(150):
        monkeypatch.setattr(textbytes, "BLOCK", random.choice([7, 16, 64, 1 << 20]))
        texts = [random.choice([None, "".join(random.choice("aBé \n\tzQ") for _ in range(random.choice([0, 1, 3, 40, 100])))]) for _ in range(5)]
        data, offsets = textbytes.flat(pa.array(texts, pa.string()))
        _, starts, ends = textbytes.words(data, offsets, textbytes.SPACE)
        bounds = textbytes.word_bounds(starts, offsets)
        got = [[bytes(data[a:b]).decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(bounds, bounds[1:])]
        assert got == [brute.blank_words(t) for t in texts]


def test_op1_language():
    render = chat_template.compile_template(
        "{% for t in l %}{{ loop.index }}{{ t.a | upper }}{% if not loop.last %},{% endif %}{% endfor %}{%- set q = 'x' ~ (1 + 2) -%}  {{ q }}{# c #}{{ m is defined }}"
    )
    assert render({"l": [{"a": "p"}, {"a": None}]}) == ("1P,2x3false", [])
    assert chat_template.fold(chat_template.parse("a{{ 'b' ~ 1 }}{% if 1 > 2 %}x{% else %}c{% endif %}")) == (chat_template.Write(chat_template.Const("ab1c")),)
    for bad in ("{{ x.__class__.y }}", "{{ f() }}", "{% for x in 3 %}{% endfor %}", "{% if %}", "{{ 'a' * 3 }}", "{% endif %}", "{{ x | eval }}", "{# "):
        with pytest.raises(chat_template.TemplateError):
            chat_template.compile_template(bad)({"x": "s"})


def test_op1_round_trip(spark):
    random.seed(1)
    said = ["".join(random.choice("<|\\>ni\nim_") for _ in range(random.randint(0, 14))) for _ in range(300)] + ["<|im_end|>\n<|im_start|>assistant\nok", None, ""]
    rows = [(i // 4, i % 3, random.choice(["user", "assistant", None, "a\nb<|im_end|>"]), t, "x") for i, t in enumerate(said)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    formatted = chat_template.format_conversations(df)
    want = collections.defaultdict(list)
    for c, turn, role, text, _ in rows:
        want[c].append((turn, role is not None, role or "", text is not None, text or ""))
    for r in formatted.collect():
        turns = [(x[2], x[4]) for x in sorted(want[r.conv_id])]
        assert chat_template.turns_of(r.formatted) == turns
        assert [chat_template.unescape(r.formatted[a:b]) for a, b in r.loss_spans] == [t for role, t in turns if role == "assistant"]
    for r in chat_template.read_back(formatted).collect():
        turns = [(x[2], x[4]) for x in sorted(want[r.conv_id])]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert chat_template.format_conversations(df.limit(0)).collect() == []


def test_op2(spark, docs, rows):
    texts = dict(rows)
    for r in line_quality.quality(docs).collect():
        base = brute.quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
    plan = line_quality.quality(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op2_frequent_lines(spark):
    own = lambda i: " ".join("".join(chr(97 + int(d)) for d in f"{i:02}{j:02}") for j in range(60))
    rows = [(i, f"{own(i)}\nRead more at page {i}!", "h") for i in range(6)] + [(10, ("Read more at page 3!\n" * 2) + own(10)[:20], "h")]
    rows += [(20, own(20) + "\nread MORE at page", "other"), (21, own(0) + "\nRead more at page 0!", "h"), (22, None, None), (22, None, None), (23, "", "h")]
    rows += [(30, "a b c a b c a b", "h"), (30, "a b c a b c a b", "h"), (None, own(5), None)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, source string, words string")
    got = {r.doc_id: r for r in line_quality.quality(df, line_limit=5).collect()}
    assert got[0].removed_words == 5 and got[0].kept and got[20].removed_words == 0
    assert got[10].removed_words == 10 and not got[10].kept and not got[22].kept and got[30].n_repeat_words == 8
    # An exact copy adds nothing to a line's count: five texts do not pass a limit of six.
    assert {r.removed_words for r in line_quality.quality(df, line_limit=7).collect()} == {0}
    assert line_quality.quality(df.limit(0)).collect() == []


def test_op2_texts_without_frequent_lines(spark):
    rows = [(i, f"own line {'x' * i}\n\nRead more at page {i}!\nlast {'y' * i}\n", "h") for i in range(7)]
    rows += [(3, rows[3][1], "h"), (8, "Read more at page 1!", "h"), (9, "Read more at page 1!\nz", "other"), (10, None, "h"), (11, "", None), (None, "a\nread more at PAGE\nb", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.clean_text) for r in line_quality.quality(df, line_limit=5).collect()]
    often = re.compile("read more at page", re.I)
    cut = lambda t, host: t if t is None or host != "h" else "\n".join(x for x in t.split("\n") if not often.match(x))
    assert sorted(got, key=str) == sorted([(i, cut(t, host)) for i, t, host in rows], key=str)
    assert {r.clean_text for r in line_quality.quality(df, line_limit=50).collect()} == {t for _, t, _ in rows}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_op3(docs, rows, size, percent):
    assert {tuple(r) for r in set_join.jaccard_groups(docs, size=size, percent=percent).collect()} == brute.jaccard(rows, size, percent)


def test_op3_large_group_and_odd_rows(spark, odd):
    random.seed(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(random.choice([0, 1, 2, 3])):
            w[random.randrange(len(w))] = random.choice(["q", "r"])
        rows.append((i, " ".join(w)))
    got = {tuple(r) for r in set_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=4, percent=85).collect()}
    assert got == brute.jaccard(rows, 4, 85)
    found = sorted(map(tuple, set_join.jaccard_groups(odd).collect()), key=str)
    assert found == sorted([(1, 0, 1), (2, 0, 2), (3, 4, 3), (3, 4, 3), (4, 4, 3), (None, 4, None), (5, 0, 5), (6, 1, 6), (7, 2, 7)], key=str)
    assert set_join.jaccard_groups(odd.limit(0)).collect() == []


def test_tokens_are_the_librarys():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    random.seed(2)
    texts = ["", "it's don't 'll x'sfoo ''s <|endoftext|>", "日本語 тест ½", "\r\n\r\n x ", "　 x"]
    texts += ["".join(random.choice(" \n\t'sd,.1aé ل😀<|e") for _ in range(random.randint(0, 30))) for _ in range(500)]
    for text in texts:
        assert tokens.token_ids("byte_bpe_50k.json", text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_document_ids_are_the_librarys(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(13)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n <|endoftext", ""]
    texts += ["".join(random.choice([" ", "a", "é", "\n", "<|", "|>", "<|endoftext|>", "endoftext", "'s"]) for _ in range(random.randint(0, 20))) for _ in range(500)]
    for text in texts:
        assert tokens.document_ids("byte_bpe_50k.json", text).tolist() == own.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:4])], "doc_id long, text string")
    wanted = {i: own.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts[:4])}
    for r in complement_packing.pack(df).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(wanted[r.doc_id] + [0], "<u4").tobytes())
    for r in bfd_packing.packed_sequences(df, capacity=64).collect():
        ids = np.frombuffer(r.input_ids, "<u2")
        for doc, a, b in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:]):
            assert ids[a:b].tolist() == wanted[doc] + [50256]


def test_op4(odd):
    back = collections.defaultdict(list)
    for r in bfd_packing.packed_sequences(odd, capacity=64).collect():
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64 and not ids[r.n_tokens :].any()
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            back[doc].append((start, ids[a:b].tolist()))
    for doc, text in dict(ODD).items():
        want = tokens.token_ids("byte_bpe_50k.json", text or "").tolist() + [50256]
        copies = sum(k == doc for k, _ in ODD)
        assert sorted(x for _, p in back[doc] for x in p) == sorted(want * copies)
        if copies == 1:
            assert [x for _, p in sorted(back[doc]) for x in p] == want
    assert bfd_packing.packed_sequences(odd.limit(0)).collect() == []


def test_op4_is_best_fit_decreasing():
    random.seed(4)
    for _ in range(200):
        lengths = [random.randint(1, random.choice([3, 10, 20])) for _ in range(random.randint(0, 60))]
        bins, plain = bfd_packing.best_fit_decreasing(lengths, 20), []
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 20 for b in bins)
        for x in sorted(lengths, reverse=True):
            fits = [i for i, room in enumerate(plain) if room >= x]
            if fits:
                plain[min(fits, key=plain.__getitem__)] -= x
            else:
                plain.append(20 - x)
        assert len(plain) == len(bins)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_op5(docs, odd, rows, table):
    source, texts = (docs, rows) if table == "documents" else (odd, ODD)
    pieces = complement_packing.pack(source).collect()
    sequences, own = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
        own[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in pieces) // 2048)
    assert len(sequences) <= least * 1.02 + 1
    for doc, text in dict(texts).items():
        ids = np.append(tokens.token_ids("byte_bpe_50k.json", text or ""), np.uint32(0)).astype("<u4")
        want = [(i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(tokens.pieces(len(ids), 2048))]
        assert sorted(own[doc]) == sorted(want * sum(k == doc for k, _ in texts))
        assert sum(n for _, _, n, _ in want) == len(ids) and all(n == 2048 for _, _, n, _ in want[1:])
    assert complement_packing.pack(source.limit(0)).collect() == []


def test_op6_index():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = rng.integers(1, 4, rng.integers(1, 120))
        index, size = fm_index.FMIndex(text, 3), int(rng.integers(1, 5))
        phrases, lengths = rng.integers(1, 4, (5, size)), rng.integers(1, size + 1, 5)
        low, high = index.search(phrases, lengths)
        for i in range(5):
            wanted = phrases[i, size - lengths[i] :].tolist()
            places = [j for j in range(len(text) - len(wanted) + 1) if text[j : j + len(wanted)].tolist() == wanted]
            assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == places


def test_op6(spark, docs, rows, odd):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.items) for r in fm_index.contamination(docs, bench).collect())
    assert got == sorted(brute.contamination(rows, items))
    texts, planted = dict(rows), [r for r in fm_index.contamination(docs, bench).collect() if r.n_hit]
    cleaned = {r.doc_id: r for r in fm_index.decontaminate(docs, bench).collect()}
    assert planted
    for r in planted:
        assert not brute.contamination([(0, cleaned[r.doc_id].text)], items)[0][2] and cleaned[r.doc_id].n_chars == len(cleaned[r.doc_id].text)
        assert alnum(texts[r.doc_id], r.spans) == r.n_hit
    own = spark.createDataFrame([(7, "b c"), (8, None), (None, "e f g"), (9, ""), (7, "word word end")], "item_id long, text string")
    found = {r.doc_id: r for r in fm_index.contamination(odd, own).collect()}
    assert (found[3].n_hit, found[3].items) == (5, ["7"]) and found[1].n_words == 0 and found[7].n_hit == 3
    assert all(not r.n_hit for r in fm_index.contamination(odd, own.limit(0)).collect())
    assert fm_index.contamination(odd.limit(0), own).collect() == []
    assert fm_index.decontaminate(odd, own).schema == odd.schema


def alnum(text, spans):
    return sum(len(brute.alnum_words(text[a:b])) for a, b in spans)


def test_op7_base(docs, rows, odd):
    email, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    card, phone = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"

    def plain(text):
        digits = lambda m: re.sub(r"\D", "", m.group())
        out = [("email", m.start(), m.end()) for m in re.finditer(email, text)]
        out += [("ip", m.start(), m.end()) for m in re.finditer(ip, text) if all(int(x) <= 255 for x in m.group().split("."))]
        out += [("card", m.start(), m.end()) for m in re.finditer(card, text) if 16 <= len(digits(m)) <= 19 and weak_pii.luhn(digits(m))]
        return out + [("phone", m.start(), m.end()) for m in re.finditer(phone, text) if 8 <= len(digits(m)) <= 15]

    random.seed(6)
    parts = ["a", "b@", "@", ".", "1", "25", "300", "-", " ", "+", "(", ")", "_", "4111111111111111", "4111 1111 1111 1111", "é", "1.2.3.4", "x@y.com", "0001"]
    for _ in range(5000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        assert weak_pii.base_spans(text) == plain(text)
    texts = dict(rows)
    for r in weak_pii.personal_data(docs).collect():
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert len(weak_pii.personal_data(odd).collect()) == len(ODD) and weak_pii.personal_data(odd.limit(0)).collect() == []


def test_op7_adds_spans(spark):
    rows = [(i, f"please call {i} +1 (555) 555-{1000 + i} or mail u{i}@mail.example.com today") for i in range(60)]
    rows += [(100, "please call (415) 555-1234 today"), (101, "write to jane.doe [at] mail [dot] example [dot] com"), (102, "see chapter 415-555-1234 of it"), (103, "nothing here")]
    got = {r.doc_id: r.spans for r in weak_pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "phone:12:26" and got[101].startswith("email:9:") and got[102] == got[103] == ""
    assert weak_pii.mask(rows[60][1], got[100]) == "please call [phone] today"


def test_op8(spark):
    page = (
        '<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a href="x>y">Menu</a></nav><div class="cookie-notice">We use cookies, ok?</div>'
        '<div id="content"><div class="post"><h2>Title &amp; more</h2><p>First, with  <b>bold</b> text.<p>Second&nbsp;para, &lt;x&gt; and 5 < 6</p><ul><li>one<li>two</ul></div>'
        '<div class="share">Share!</div></div><aside>Side</aside><section id="comments"><p>Great post, thanks, very nice, I agree, yes, lots of commas, and so on</p></section>'
        '<form>Search <input></form><script>if(a<b){"</p>"}</script><footer>Foot</footer></body></html>'
    )
    assert main_content.article_text(page) == "Title & more\nFirst, with bold text.\nSecond para, <x> and 5 < 6\none\ntwo"
    odd = {"": "", "plain": "plain", "<p>": "", "<!-- never": "", "<script>x": "", "<article>Only</article><p>out</p>": "Only", "<p>" * 3000 + "deep": "deep", None: ""}
    df = spark.createDataFrame([(i, "u", h, "x") for i, h in enumerate(odd)] * 2, "page_id long, url string, html string, text string")
    got = main_content.extract(df).collect()
    assert len(got) == 2 * len(odd) and all(r.text == list(odd.values())[r.page_id] and r.n_chars == len(r.text) for r in got)
    assert main_content.extract(df.limit(0)).collect() == []


def test_op8_names_of_wrappers_and_missing_end_tags():
    story = "".join(f"<p>Paragraph {i} of the story, which goes on for a while, and then some more, until it is told.</p>" for i in range(6))
    wanted = main_content.article_text(f'<body><div class="box">{story}</div></body>')
    assert wanted.count("Paragraph") == 6
    for wrap in ('class="content-sidebar-wrap"', 'class="site has-sidebar"', 'id="page" class="no-sidebar"', 'class="post with-comments"', 'class="widget"'):
        page = f'<body><div {wrap}><div class="inner">{story}</div><div class="sidebar"><p>Side text, not of the story.</p></div></div></body>'
        assert main_content.article_text(page) == wanted, wrap
    for tag in ('<p class="promo">', "<p hidden>", '<p class="sharing">'):
        assert main_content.article_text(f"<body><div>{tag}Buy now{story}</div></body>") == wanted, tag
    items = main_content.article_text(f'<body><div>{story}<ul><li class="social">Follow us<li>One thing<li hidden>No<li>Another</ul></div></body>')
    assert items == wanted + "\nOne thing\nAnother"


def test_op9(spark, docs, odd):
    model = ecoc_language.fit(docs)
    got = ecoc_language.identify(docs.select("doc_id", "text"), model).join(docs.select("doc_id", "lang"), "doc_id").where(ecoc_language.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r for r in ecoc_language.identify(odd, model).collect()}
    assert found[1].lang_pred == found[2].lang_pred == found[5].lang_pred == "und" and found[1].score == 0 and found[1].ambiguous
    empty = ecoc_language.fit(docs.limit(0))
    assert {r.lang_pred for r in ecoc_language.identify(odd, empty).collect()} == {"und"}
    one = ecoc_language.fit(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in ecoc_language.identify(docs, one).collect()} <= {"en", "und"}


def test_op9_codewords_are_apart():
    for languages in (2, 3, 5, 9, 30):
        code = ecoc_language.codewords(languages).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2
        assert (apart[~np.eye(languages, dtype=bool)] >= (1 if languages == 2 else 2)).all()


def test_op10_distance():
    random.seed(8)
    for _ in range(1500):
        a = [random.choice("ab") for _ in range(random.randint(0, 12))]
        b = [x for x in a if random.random() > 0.2] + [random.choice("abc") for _ in range(random.randint(0, 2))]
        most, plain = random.randint(0, 6), brute.distance(a, b)
        assert fuzzy_lines.edit_distance(a, b, most) == (plain if plain <= most else None)


def _hash(word):
    data, offsets = textbytes.flat(pa.array([word]))
    return int(textbytes.words(data, offsets, textbytes.SPACE, lower=False)[0][0])


def test_op10(spark, odd):
    random.seed(9)
    base = [" ".join(random.choice("abcdefghij") * random.randint(1, 6) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(100):
        lines = []
        for _ in range(3):
            w = random.choice(base).split()
            for _ in range(random.choice([0, 1, 1, 2])):
                w[random.randrange(len(w))] = random.choice(["zz", "yy", "abc"])
            lines.append(random.choice(["", "  "]) + " ".join(w).capitalize() + random.choice(["", ".", "\r"]))
        rows.append((i, "\n".join(lines) + random.choice(["", "\n", "\n\n"])))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "a b c d e\na b c d e\nx")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, line long, form string")
    assert {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(df).collect()} == brute.line_dedup(rows, _hash)
    out = fuzzy_lines.dedup_lines(odd).collect()
    assert len(out) == len(ODD) and {r.text for r in out if r.doc_id == 3} == {"a b c d e f g"} and {r.text for r in out if r.doc_id == 4} == {""}
    assert fuzzy_lines.dedup_lines(odd.limit(0)).collect() == []


def test_op10_reach():
    random.seed(10)
    for _ in range(40):
        n = random.randint(0, 400)
        run, size = np.sort(np.array([random.randint(0, 2) for _ in range(n)], np.int64)), np.array([random.randint(5, 60) for _ in range(n)], np.int64)
        size = size[np.lexsort((size, run))]
        plain = np.zeros(n, bool)
        for i in range(n):
            for j in range(i + fuzzy_lines.WINDOW + 1, n):
                if run[i] == run[j] and size[j] - size[i] <= fuzzy_lines.allowed(size[j], 0.9):
                    plain[i] = plain[j] = True
        assert (fuzzy_lines._beyond(run, size, 0.9) == plain).all()


def test_op10_window_does_not_change_groups(spark, monkeypatch):
    random.seed(11)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = list(base)
        words[random.randrange(40)] = f"x{random.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute.line_dedup(rows, _hash)
    monkeypatch.setattr(fuzzy_lines, "NEIGHBOURS", 1)
    monkeypatch.setattr(fuzzy_lines, "WINDOW", 2)
    from pyspark import cloudpickle

    from veilframe.llm import fuzzy_lines as module

    cloudpickle.register_pickle_by_value(module)
    try:
        assert {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(df).collect()} == wanted
    finally:
        cloudpickle.unregister_pickle_by_value(module)


def test_op10_finds_every_pair_by_edits_alone(spark):
    # Pairs of lines of their own, as far apart as allowed and one edit further; SimHash bits play no part.
    random.seed(12)
    rows = []
    for i in range(160):
        words = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(1, 7))) for _ in range(random.choice([9, 10, 12, 19, 20, 35, 60, 110]))]
        words += random.sample(words, min(2, len(words)))
        edited = list(words)
        for _ in range(len(words) // 10 + random.choice([0, 0, 1])):
            at = random.randrange(len(edited))
            edited[at : at + 1] = random.choice([["zz"], [], [edited[at], "yy"]])
        rows.append((i, " ".join(words) + "\n" + " ".join(edited)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(df, distance=None).collect()} == brute.line_dedup(rows, _hash, distance_bits=64)
