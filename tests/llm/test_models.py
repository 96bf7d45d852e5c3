"""Tokens against the library, language and extraction on small tables, the pipeline against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from fathomframe.llm import langid, tokens, wrappers

DOC = "doc_id long, text string, lang string, source string, ids string"


def odd_texts():
    r = random.Random(3)
    fixed = [None, "", " ", "  a", "x" * 300, "ab" * 200 + " " + "the" * 90, "漢字 混ざる text\n\n\ttabs", "▁odd▁ marker", "²½ .²", "é ö",
             "\U0001f600 smile‍", "straightforward representations!!!! ........... 1234567890", "\x00nul", "a" * 59 + "b" * 5,
             "word " * 10, "<s> </s> <unk> <0x41>"]
    return fixed + ["".join(r.choice("abcdeé \n.,T漢_0²▁") for _ in range(r.randrange(1, 200))) for _ in range(60)]


@pytest.fixture(params=[False, True], ids=["hints", "no hints"])
def hints(spark, request):
    """Whether Spark may not broadcast."""
    held = {"spark.sql.optimizer.disableHints": str(request.param).lower(), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k in held:
        spark.conf.unset(k)


@pytest.mark.parametrize("limit", [tokens.DICTIONARY_BYTES, 1500, 0])
def test_encode_equals_the_library_and_decodes(frame, limit, hints):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    pieces, texts = tokens.Pieces.load(), odd_texts()
    df = frame([(i, t, "en", "s", "old") for i, t in enumerate(texts)] + [(3, texts[3], None, None, None)], DOC)
    out = tokens.decode(tokens.encode(df, pieces, limit=limit), pieces).collect()
    assert len(out) == len(texts) + 1
    for row in out:
        text = texts[row.doc_id] or ""
        assert list(row.ids) == library.encode(text)
        assert row.decoded == text.replace(tokens.SPACE, " ") == library.decode(list(row.ids))


@pytest.mark.parametrize("limit", [tokens.DICTIONARY_BYTES, 0])
def test_ids_and_decoded_text_come_from_one_python_node(frame, limit):
    pieces, texts = tokens.Pieces.load(), odd_texts() + ["a ", "  ", "a  b c"]
    df = frame([(i, t, "en", "s", "old") for i, t in enumerate(texts)], DOC)
    out = tokens.encode(df, pieces, limit=limit, decoded="decoded")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not limit or plan.count("ArrowEvalPython") == 1
    apart = {r.doc_id: (r.ids, r.decoded) for r in tokens.decode(tokens.encode(df, pieces), pieces).collect()}
    assert {r.doc_id: (r.ids, r.decoded) for r in out.collect()} == apart


def test_merges_of_many_words_equal_those_of_one():
    r = random.Random(7)
    pieces = tokens.Pieces.of(tokens.BPE, [("<unk>", 0.0, 2)] + [(p, -r.randrange(9), 1) for p in (
        "a", "b", "ab", "ba", "aa", "aba", "abab", "bb", "abb")])
    words = sorted({"".join(r.choice("abx") for _ in range(r.randrange(1, 30))) for _ in range(300)} | {"ab" * 30})
    ranks = {s: i for i, s in enumerate(sorted(set(pieces.score.values()), reverse=True))}
    offsets, edges = [0], []
    for w in words:
        for i in range(len(w)):
            for n in range(1, len(w) - i + 1):
                p = w[i : i + n]
                if p in pieces.ids or n == 1:
                    known = p in pieces.ids
                    rank, at = (ranks[pieces.score[p]], pieces.ids[p]) if known else (tokens._NO_PIECE, tokens._NO_PIECE)
                    edges.append(rank << 32 | i << 26 | n << 20 | at)
        offsets.append(len(edges))
    out = tokens.merged(pa.array(words), np.array(offsets), np.array(edges), pieces)
    assert out.column(1).to_pylist() == [pieces.fold_long(w) for w in words]


def test_stretches_cut_together_give_the_words_of_each():
    cut = re.compile(tokens.CUTS[0])
    for stretches in ([], ["▁a1", "▁b.c", "▁"], ["▁", "▁x"], ["▁▁a", ",", "b"], ["▁²½", "▁é", "▁\n"], ["▁"]):
        words, n = tokens._cut_words(cut, stretches)
        each = [cut.findall(x) for x in stretches]
        assert words == [w for x in each for w in x] and n.tolist() == [len(x) for x in each]


def test_stretches_are_the_escaped_text():
    pieces = tokens.Pieces.load()
    for text in odd_texts() + ["a b", "a b ", " a", "a  b", "a ▁b", "▁", "a▁b"]:
        assert "".join(tokens.headed(pieces.stretches(text))) == pieces.escaped(text)


def test_unigram_path_is_the_best(frame, hints):
    r = random.Random(5)
    rows = [("<unk>", 0.0, 2)] + [(p, -r.uniform(1, 9), 1) for p in ("▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab")]
    pieces = tokens.Pieces.of(tokens.UNIGRAM, rows)
    worst = min(pieces.score.values()) - 10

    def best(word):
        held = [0.0]
        for e in range(1, len(word) + 1):
            ways = [held[s] + pieces.score[word[s:e]] for s in range(e) if word[s:e] in pieces.score]
            held.append(max(ways + ([held[e - 1] + worst] if word[e - 1] not in pieces.score else [])))
        return held[-1]

    texts = ["".join(r.choice("abc d") for _ in range(r.randrange(0, 14))) for _ in range(40)] + ["abc" * 40]
    for row in tokens.encode(frame([(i, t, "", "", "") for i, t in enumerate(texts)], DOC), pieces).collect():
        cost = sum(pieces.score.get(rows[i][0], worst) for i in row.ids)
        assert cost == pytest.approx(best(pieces.escaped(texts[row.doc_id])))


def test_encode_empty_table(frame):
    assert tokens.encode(frame([], DOC), tokens.Pieces.load()).collect() == []


def languages(n):
    r = random.Random(2)
    stems = {"en": ["the", "and", "ing", "tion", "wh"], "de": ["der", "sch", "ung", "ä", "ein"], "fr": ["le", "eau", "ç", "é", "ou"]}
    rows = []
    for i in range(n):
        lang = r.choice(sorted(stems))
        rows.append((i, " ".join("".join(r.choice(stems[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(5, 60))), lang, "s", "x"))
    return rows


def test_language_on_held_out_rows(frame):
    rows = languages(300) + [(900, None, "en", "s", "x"), (901, "12 34 !!", "en", "s", "x"), (902, "", None, "s", "x"),
                             (None, "the and", "en", "s", "x"), (903, "x" * 300_000, None, "s", "x"), (5, "the whing", None, "s", "x")]
    df = frame(rows, DOC)
    model = langid.train(df)
    assert model.labels == ["de", "en", "fr"] and (np.abs(model.weights).any(axis=1)).sum() < langid.FEATURES / 4
    got = langid.identify(df, model).select("*", langid.held_out(df.doc_id).alias("held")).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held and r.doc_id < 900]
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (900, 901, 902))


def test_held_out_rows_teach_nothing(frame):
    rows = languages(120)
    df = frame(rows, DOC)
    held = {r.doc_id for r in df.where(langid.held_out(df.doc_id)).collect()}
    other = frame([(d, "zz" if d in held else t, "qq" if d in held else l, s, x) for d, t, l, s, x in rows], DOC)
    a, b = langid.train(df), langid.train(other)
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_ftrl_against_the_formula():
    """Follow the regularised leader row by row over all coordinates, each weight from its sums in closed form."""
    r = np.random.default_rng(4)
    rows = []
    for _ in range(40):
        at = np.sort(r.choice(30, 6, replace=False))
        rows.append((at, r.random(6), int(r.integers(3))))
    z, n, w = np.zeros((31, 3)), np.zeros((31, 3)), np.zeros((31, 3))
    order = np.random.default_rng(7)
    for _ in range(langid.EPOCHS):
        for i in order.permutation(len(rows)):
            x = np.zeros(31)
            x[rows[i][0]], x[30] = rows[i][1], 1
            logits = np.exp(x @ w)
            for c in range(3):
                error = logits[c] / logits.sum() - (c == rows[i][2])
                for j in np.flatnonzero(x):
                    g = x[j] * error
                    z[j, c] += g - (np.sqrt(n[j, c] + g * g) - np.sqrt(n[j, c])) / langid.ALPHA * w[j, c]
                    n[j, c] += g * g
            for j in range(31):
                for c in range(3):
                    l1 = langid.L1 if j < 30 else 0
                    w[j, c] = 0 if abs(z[j, c]) <= l1 else -(z[j, c] - np.sign(z[j, c]) * l1) / ((langid.BETA + np.sqrt(n[j, c])) / langid.ALPHA + langid.L2)
    fast = langid.fit_ftrl(rows, 3)
    assert np.allclose(fast[:30], w[:30]) and np.allclose(fast[-1], w[-1]) and not fast[30:-1].any()


def test_nothing_to_learn(frame):
    df = frame([(1, "some text", None, "s", "x")], DOC)
    assert langid.train(df).labels == []
    assert [r.lang_pred for r in langid.identify(df, langid.train(df)).collect()] == ["und"]
    assert langid.identify(df.limit(0), langid.train(df.limit(0))).collect() == []


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = "Das ist ein Text, der länger ist. " * 30
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_PIECE", 17)
    assert np.array_equal(whole, langid.gram_counts(text))


PAGES = [
    (None, ""), ("", ""), ("plain < text", "plain < text"), ("<p>a<p>b", "a\n\nb"),
    ("<div class='content'><p>One &amp; two</p><ul><li>a</li><li>b</li></ul><div class=comments><p>hi</p></div></div><aside>x</aside>", "One & two\n\na\n\nb"),
    ("<body><nav>m</nav><div><div class=\"cookie-notice\">c</div><h2>T</h2><p>x <span class='ad'>AD</span> y</p></div><footer>f</footer>", "T\n\nx y"),
    ("<article><h1>T</h1><p>x<br>y<b>z</p><form><input><label>q</label></form><script>var t='</p>'</script><section class='comments'><article><p>c</p></article></section></article>", "T\n\nx yz"),
    ("<p>" * 3000 + "deep", "deep"), ("<div" * 3, "<div<div<div"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_article(page, text):
    assert wrappers.article(page, None) == text


def test_wrapper_has_slots_repeats_and_options():
    pages = [f"<html><body><nav><a>Home</a></nav><article><h1>T{i}</h1>{''.join(f'<p>par {i} {j}</p>' for j in range(1 + i))}"
             f"{'<aside>more</aside>' if i == 2 else ''}</article><footer>(c) site</footer></body></html>" for i in range(4)]
    wrapper = "".join(n.expression() for n in wrappers.infer(pages))
    assert "<h1>#</>(<p>#</>)+(<aside>more</>)?</>" in wrapper and "site" in wrapper
    assert wrappers.main_region(wrappers.slots(wrappers.infer(pages))) == ("html", "body", "article")


def test_extract_by_host(frame):
    def page(i, n):
        return (f"<html><body><ul class=menu><li>Home</li></ul><div id=wrap><div class=text>{''.join(f'<p>Sentence {i} {j} of the page.</p>' for j in range(n))}</div>"
                f"<div class=side><p>S{i}</p></div></div></body></html>")

    rows = [(i, f"http://a.example/{i}", page(i, 2 + i % 4), "t", 1) for i in range(40)] + [
        (40, None, page(1, 2), "t", 1), (41, "http://b.example/", None, "t", 1), (3, "http://a.example/3", page(3, 5), "t", 1)]
    got = wrappers.extract(frame(rows, "page_id long, url string, html string, text string, n_chars long")).collect()
    assert len(got) == len(rows)
    for r in got:
        n = (r.html or "").count("Sentence")
        assert r.text.count("Sentence") == n and r.n_chars == len(r.text) and "Home" not in r.text
        assert r.text == "\n\n".join(f"Sentence {x} of the page." for x in [p.split(" of the")[0] for p in (r.html or "").split("Sentence ")[1:]])
    empty = frame([], "page_id long, url string, html string")
    assert wrappers.extract(empty).collect() == []


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    from tests.llm.test_duplicates import brute_components
    from tests.llm.test_words import brute_targets

    rows = languages(150)
    texts = [t for _, t, *_ in rows]
    rows += [(200 + i, texts[i], rows[i][2], "t" if i % 2 else None, "x") for i in range(12)]
    rows += [(300, None, "en", "s", "x"), (301, "", "en", "s", "x"), (302, "77 88", "de", "s", "x"), (303, texts[40] + " more", rows[40][2], "s", "x"),
             (None, "the and the whing of a page", "en", "s", "x"), (202, texts[2], rows[2][2], "s", "x")]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    def kept(name, docs):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        return [tuple(r) for r in out.collect()]

    spoken = kept("language_id", docs)
    assert sorted(spoken, key=str) == sorted((r for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=str)
    first = kept("exact_dedup", docs)
    best = {}
    for r in rows:
        t = r[1] or ""
        best[t] = max(best.get(t, -1), r[0] if r[0] is not None else -1)
    assert sorted(((r[1] or ""), r[0] if r[0] is not None else -1) for r in first) == sorted(best.items())
    near = kept("near_dedup", docs)
    want = brute_components([(r[0], r[1]) for r in rows])
    assert sorted(near, key=str) == sorted((r for r in rows if want[r[0] if r[0] is not None else 1 << 62] == (r[0] if r[0] is not None else 1 << 62)), key=str)
    mixed = kept("mix_sources", docs)
    assert set(mixed) <= set(rows) and max(mixed.count(r) for r in set(mixed)) <= 3 * rows.count(mixed[0]) + 3
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    for s, target in brute_targets(sizes).items():
        assert abs(sum(len((r[1] or "").split()) for r in mixed if r[3] == s) - target) <= 120
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect())


def test_letters_of_all_planes():
    assert langid.gram_counts(chr(0x20000) + chr(0x2A700)) is not None
    assert langid.gram_counts("\U0001F600 12 \U000F0000") is None


def test_every_template_of_a_host_has_its_region(frame):
    """The minority's pages name two articles; over all of them the first is the main one, on one page the second."""
    def minor(i):
        return (f"<html><body><div class=b><article><p>{'Main text of page ' * 6}{i}</p></article></div>"
                f"<div class=c><article><p>{'Side text ' * (40 if i == 3 else 1)}{i}</p></article></div></body></html>")

    rows = [(i, f"http://a.example/m{i}", minor(i)) for i in range(12)]
    rows += [(100 + i, f"http://a.example/{i}", f"<html><body><div class=a><article><p>{'Usual text ' * 30}{i}</p></article></div></body></html>") for i in range(60)]
    got = wrappers.extract(frame(rows, "page_id long, url string, html string"), share=5).collect()
    for r in got:
        assert r.text == (f"{'Usual text ' * 30}{r.page_id - 100}" if r.page_id >= 100 else f"{'Main text of page ' * 6}{r.page_id}")


def test_near_dedup_tells_rows_with_one_id_apart(spark, frame):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "en", "s", "x"), (None, base + " more", "en", "s", "x"), (None, "a clean text of its own without any copy", "en", "s", "x"),
            (None, "one text that stands here twice under no id " * 8, "en", "s", "x"), (None, "one text that stands here twice under no id " * 8 + "more", "en", "s", "x"),
            (7, "another clean text under a repeated id", "en", "s", "x"), (7, base + " end", "en", "s", "x")]
    got = corpus_pipeline.near_dedup(spark, frame(rows, DOC), "").collect()
    texts = sorted(r.text[:20] for r in got)
    assert texts == sorted(t[:20] for t in (rows[0][1], rows[2][1], rows[3][1], rows[5][1]))
