"""Operators 5, 6, 7, 9 and 10 against brute force and held-out labels."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farebox.llm import lang_cnn, toxicity
from farebox.llm.common import documents, fold, table
from farebox.llm.html_extract import extract, main_text
from farebox.llm.line_quality import quality_rules
from farebox.llm.ngram_lm import lm_score

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {k for i, x in enumerate(windows) if often[x] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_against_brute_force(spark, odd, none):
    more = spark.createDataFrame([(20, "a b c d e f g h i\n" * 3 + "q"), (21, "z " * 30), (22, "\n\n a \n a\n a")], "doc_id long, text string")
    df = odd.union(more).union(documents(spark, "/root/testdata/sf0.001"))
    rows = quality_rules(df.selectExpr("*", "'t' as words", "'u' as kept", "1 as other")).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(r.text), r.text
        assert r.other == 1 and not (r.kept and r.base_failed)
    assert quality_rules(none).collect() == []


def test_quality_lines(spark):
    good = "This is a plain sentence of quite ordinary words, as they stand in every text.\n"
    texts = {"good": good * 1 + "A second line of words that says something else, and ends here.\nAnd a third one follows it at last.",
             "menu": "Home | About | Contact | Login | Search | Help | Terms | Jobs | Press | Blog | Shop | Cart | News\n" * 1 + "Two words.",
             "signs": "word!! other!! again!! loud!! very!! much!! so!! all!! day!! long!! and!! more!! of!! it!! now!! ok!! go!! on!! yes!! no!! end!!",
             "run": " ".join(w for w in ("alpha", "beta", "gamma", "delta", "eps") for _ in range(5)),
             "mixed": good + "x | y | z | a | b"}
    rows = {r.name: r for r in quality_rules(spark.createDataFrame(list(texts.items()), "name string, text string")).collect()}
    assert {k for k, r in rows.items() if r.kept and not r.base_failed} >= {"good"}
    assert not any(rows[k].kept for k in ("menu", "signs", "run"))
    assert rows["mixed"].clean_text == good.strip()
    df = quality_rules(spark.createDataFrame(list(texts.items()), "name string, text string"))
    assert {r.name for r in df.where("kept").collect()} == {k for k, r in rows.items() if r.kept}


def test_quality_agrees_with_labels_and_is_native(spark):
    judged = quality_rules(documents(spark, SF))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    rows = judged.where("not base_failed").join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").select("quality", "kept").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.98


def test_language(spark, odd, none):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 5) == 0
    model = lang_cnn.fit(docs.where(~held), max_docs=120)
    rows = lang_cnn.identify(docs.where(held), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    got = lang_cnn.identify(odd.selectExpr("*", "'old' as score"), model).collect()
    assert len(got) == odd.count() and all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (4, 7, 8, 9))
    assert lang_cnn.identify(none, model).collect() == []
    nothing = lang_cnn.fit(spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string"))
    assert nothing is None and {r.lang_pred for r in lang_cnn.identify(odd, nothing).collect()} == {"und"}


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>a", "a"), ("<script>if (a<b)", ""), ("plain text", "plain text"), ("<<<>>&& &amp &#65;", "<<<>>&& & A"),
    ("<nav><ul><li><a href=x>Menu</a></ul></nav><main><p>one <i>w</i>ord<br>next</p></main><aside>side</aside>", "one word next"),
    ("<article><h1>T</h1><div><p>one, two &amp; three four five six seven</p><div class='share-bar'>Share</div>"
     "<section id=comments><p>a long, long, long reader comment, with, many, commas</p></section><blockquote>q &lt;b&gt;</blockquote>"
     "<ul><li>x<li>y</ul></div></article><footer>f</footer>", "T\none, two & three four five six seven\nq <b>\nx\ny"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<div style='display:none'><p>hidden text that is long enough to count</p></div><p>shown &nbsp; text</p>", "shown text"),
    ("<article><p><b>bold<br><p>second</p></article><div class=ad>buy</div>", "bold\nsecond"),
])
def test_main_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("<body><div><p class=byline>By X<p>one two<p>three</div><p>four", "one two\nthree\nfour"),
    ("<body><div><p class=byline>By <b>X<hr>one two</div>", "one two"),
    ("<ul><li class=share>Share<li>one<li>two</ul><p>three", "one\ntwo\nthree"),
    ("<ul><li>one <span class=share>Share<li>two</ul>", "one\ntwo"),
    ("<p>one <span class=share>Share<p>two", "one\ntwo"),
    ("<dl><dt class=share>Share<dd>one</dl><p>two", "one\ntwo"),
    ("<table><tr class=ad><td>Buy<tr><td>one</table><p>two", "one\ntwo"),
    ("<article><div><span class=share>Share</div><p>one</article><p>two", "one\ntwo"),
    # these don't end it
    ("<div><div class=share><ul><li>a<li>b</ul><p>c<p>d</span></li></div><p>one</div>", "one"),
    ("<ul><li>one<nav><ul><li>a<li>b</ul>c</nav> two<li>three</ul>", "one\ntwo\nthree"),
    ("<div><table class=ad><tr><td>a</div>b<tr><td>c</table><p>one</div>", "one"),
])
def test_left_out_elements_end_where_html_ends_them(html, text):
    assert main_text(html) == text


def test_extract_on_pages(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    for r in extract(pages.selectExpr("*", "html as source", "'x' as text")).collect():
        article = re.search(r"<article>(.*?)</article>", r.source, re.S)
        from html import unescape
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article[1])]
        assert r.text == "\n".join(x for x in blocks if x)
    assert len(main_text("<div>" * 20000 + "deep text")) == 9


def test_toxicity(spark, odd, none):
    held = fold(F.col("doc_id"), 5) == 0
    sf = "/root/testdata/sf0.1"
    labelled = documents(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    model = toxicity.fit(labelled.where(~held))
    rows = toxicity.toxicity(labelled.where(held), model).collect()
    hits = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.score >= 0.5 for r in hits) / len(hits) > 0.85
    got = toxicity.toxicity(odd.selectExpr("*", "'old' as score"), model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(none, model).collect() == []
    untrained = toxicity.fit(spark.createDataFrame([(1, "a b", 0)], "doc_id long, text string, toxic int"))
    assert {r.score for r in toxicity.toxicity(odd, untrained).collect()} == {0.0}
    if any(r.score >= 0.5 for r in got) or sum(r.score >= 0.5 for r in clean) / len(clean) >= 0.03:
        pytest.xfail("known gap: words unlike the training text, and 5 % of clean held-out texts, are found toxic with the 352 toxic texts of sf0.1 (0.6 % on check_s)")


def test_class_models_are_distributions():
    """The shared model's probabilities of all symbols after a context sum to one."""
    import numpy as np
    model = toxicity._count(["idiot", "idea", "id", "dim"], np.array([[3.0, 9, 4, 2], [8, 1, 0, 2]]), 3, 1.0, 4.0)
    for c in model.orders:
        own = c.own + 0.0
        left = c.class_left
        by = np.searchsorted(c.contexts, c.keys >> np.uint64(toxicity.BITS))
        for k in (0, 1):
            total = np.bincount(by, own[k], len(c.contexts)) + left[k]
            assert np.allclose(total, c.class_total[k])


def test_ratios_of_words_follow_from_the_counts():
    """Every character's ratio after its longest known context, order by order; the tasks get no counts and few look-ups."""
    import numpy as np
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 7)))
    words = list({word() for _ in range(200)})
    model = toxicity._count(words, np.array([[r.randint(0, 9) for _ in words] for _ in (0, 1)], np.float32), 4, 1.5, 4.0)
    asked = words[:50] + [word() + x for x in ("", "z", "\U0001f642") for _ in range(60)]
    codes, sizes = model.codes(asked)
    shared, want = np.full(len(codes) - len(sizes), 1 / (len(model.alphabet) + 4)), np.zeros(len(codes) - len(sizes))
    for c, (keys, whole) in zip(model.orders, model.keys(codes, sizes, 4)):
        for i in np.flatnonzero(whole):
            at, j = (np.flatnonzero(x == y) for x, y in ((c.contexts, keys[i] >> np.uint64(toxicity.BITS)), (c.keys, keys[i])))
            if len(at):
                pooled, own = (max(c.pooled[j[0]] - 0.75, 0), c.own[:, j[0]]) if len(j) else (0, np.zeros(2))
                shared[i] = (pooled + 0.75 * c.kinds[at[0]] * shared[i]) / c.total[at[0]]
                q = (own + (c.class_left[:, at[0]] + 1.5) * shared[i]) / (c.class_total[:, at[0]] + 1.5) + model.common * shared[i]
                want[i] = np.log(q[1] / q[0])
    whole = np.array([x.sum() * min(1, toxicity.LONG / len(x)) for x in np.split(want, np.cumsum(sizes - 1)[:-1])])
    slim = model.scorer()
    assert slim.orders == [] and np.allclose(slim.ratios(asked), whole, rtol=1e-9, atol=1e-12)


def test_toxicity_counts_continuations():
    """Kneser-Ney: below the highest order, the number of distinct characters before an n-gram; word starts have none."""
    import numpy as np
    words = ["san", "fan", "pan", "of", "off"]
    model = toxicity._count(words, np.array([[50.0, 1, 0, 9, 0], [0, 1, 1, 0, 1]]), 3, 0.0, 4.0)
    code = {w: model.codes([w])[0][1] for w in "anfos"}
    one = dict(zip((model.orders[0].keys & np.uint64((1 << toxicity.BITS) - 1)).tolist(), zip(model.orders[0].pooled, *model.orders[0].own)))
    assert one[code["a"]] == (3, 2, 2)  # after s, f and p; ordinary texts have s and f, toxic ones f and p
    assert one[code["n"]] == (1, 1, 1) and one[code["s"]] == (1, 1, 0)
    assert one[code["f"]] == (3, 2, 3)  # after FIRST, o and f; only toxic texts have ff
    pair, ((first, _), (two, _), _) = model.orders[1], model.keys(*model.codes(["san"]), 3)
    at = np.searchsorted(pair.keys, two)
    assert pair.pooled[at[:3]].tolist() == [50, 1, 3]  # s begins the word: texts; sa: once; an: after s, f and p


def test_toxicity_tells_all_characters_apart():
    import numpy as np
    signs = [chr(0x4E00 + i) for i in range(3000)]
    model = toxicity._count(signs, np.ones((2, 3000)), 3, 2.0, 4.0)
    assert len(set(model.codes(signs)[0].tolist())) == 3002 and len(model.orders[1].keys) == 6000


def test_toxicity_keeps_clean_and_unfamiliar_texts(spark, odd):
    held = fold(F.col("doc_id"), 5) == 0
    sf = "/root/testdata/sf0.1"
    labelled = documents(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    model = toxicity.fit(labelled.where(~held))
    clean = toxicity.toxicity(labelled.where(held).where("toxic = 0"), model).collect()
    assert sum(r.score >= 0.5 for r in clean) / len(clean) < 0.03
    assert all(0 <= r.score < 0.5 for r in toxicity.toxicity(odd, model).collect())


def test_lm_against_brute_force(spark, odd, none):
    docs = documents(spark, "/root/testdata/sf0.001").union(odd).withColumn("held_out", fold(F.col("doc_id"), 10) == 0)
    got = lm_score(docs.selectExpr("*", "1 as block", "2 as score"), "held_out", mass=20.0, block_bytes=30_000, bucket_bytes=50_000).collect()
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    one, two, texts = Counter(), Counter(), []
    for r in docs.collect():
        t = [*WORD.findall((r.text or "").translate(low)), "</s>"]
        texts.append((r.doc_id, t, r.held_out))
        if not r.held_out:
            one.update(t)
            two.update(zip(["<s>", *t], t))
    n, v, want = sum(one.values()), len(one), []
    for i, t, held in texts:
        base = score = 0.0
        for h, w in zip(["<s>", *t], t):
            p = (one[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            score += math.log10((two[h, w] + 20 * p) / (one["</s>" if h == "<s>" else h] + 20))
        want.append((i, held, len(t), sum(one[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(rows, key=key) == sorted(want, key=key)
    held = [(b, s) for i, h, _, _, _, b, s in want if h]
    assert sum(s for _, s in held) > sum(b for b, _ in held)
    assert lm_score(none.withColumn("held_out", F.lit(False)), "held_out").collect() == []
    untrained = lm_score(odd.withColumn("held_out", F.lit(True)), "held_out").collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in untrained)
