"""Operators on single texts and on token streams against brute-force versions."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from dimflow.llm import chat_format, decontaminate, html_blocks, quality_rules, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "a b c"), (5, "x" * 200_000), (6, "one two three four five six seven eight " * 40)]


def texts(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns with names that operators use inside
        df = df.withColumns({c: F.lit("mine") for c in ("row", "words", "hashes", "kept", "n_words", "source", "lang")})
    return df


def base_counts(text):
    t = text or ""
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def test_rule_counts(spark):
    rng = random.Random(1)
    rows = ODD + [(10 + i, "".join(rng.choice(["a ", "b ", "c\n", "d\x0b", "é# ", "\r\n"]) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    got = quality_rules.rule_counts(texts(spark, rows)).select(
        "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    for r in got.collect():
        assert tuple(r)[1:] == base_counts(r[0]), r[0]


def test_quality_verdict_separates_and_is_whole(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice("the of and to in is river town bread winter".split()) for _ in range(60)) for _ in range(60)]
    bad = [" ".join("".join(rng.choice(string.ascii_uppercase) for _ in range(5)) + "!!" for _ in range(60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(900, None), (None, good[0]), (0, good[0])]
    docs = texts(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(2, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect())
    assert ids == sorted([*range(60), -1, 0])
    empty = quality_rules.keep_good(docs.limit(0), labels.limit(0))
    assert empty.count() == 0


def distance_to_part(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_edit_matching_against_brute_force(spark):
    rng = random.Random(3)
    say = lambda n: "".join(rng.choice("abcde  ") for _ in range(n))
    items = [(i, say(60 + 10 * i)) for i in range(5)] + [(9, items_text := say(90)), (8, items_text), (7, "short"), (6, None), (None, say(80))]
    rows = list(ODD)
    for k in range(60):
        item = decontaminate.normal(rng.choice([t for _, t in items if t]))
        chars = list(item)
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(chars))
            chars[at] = rng.choice(["", "z", chars[at] + "q"])
        rows.append((100 + k, say(rng.randint(0, 50)).upper() + "".join(chars) + say(rng.randint(0, 50))))
    found = decontaminate.matches(texts(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found.collect()}
    want = {}
    for doc, text in rows:
        for i, item in items:
            item = decontaminate.normal(item)
            if i is None or len(item) < decontaminate.MIN_CHARS or len(text or "") > 10_000:
                continue
            d = distance_to_part(item, decontaminate.normal(text))
            if d <= int(len(item) * decontaminate.BUDGET):
                want[doc, i] = d
    assert got == want and len(want) > 20


def test_leaks_go_and_the_rest_stays(spark):
    item = "a passage of the benchmark that is long enough to be told apart from anything else"
    docs = texts(spark, [*ODD, (50, f"before {item.upper()} after"), (51, "nothing of the kind")])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.without_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == len(ODD) + 1
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == len(ODD) + 2
    assert decontaminate.matches(docs.limit(0), items).count() == 0


def test_blocks_of_items(spark):
    items = spark.createDataFrame([(i, f"item number {i} " * 5) for i in range(10)], "item_id long, text string")
    assert [len(b) for b in decontaminate.blocks(items, 200)] == [3, 3, 3, 1]


@pytest.fixture(scope="module")
def unigram():
    pieces, byte_pieces = token_counts.vocabulary()
    assert byte_pieces
    return pieces


def test_token_counts_equal_the_tokenizer(spark, unigram):
    tokenizers = pytest.importorskip("tokenizers")
    low = min(s for _, s in unigram) - 1
    pieces = unigram + [("<0x%02X>" % i, low) for i in range(256)]
    reference = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", 0.0), *pieces], 0, True))
    counter = token_counts.Counter(pieces, True)
    rng = random.Random(4)
    cases = ["", "a", "  a   b ", "\n\nx\ty", "日本 語 é 🎉🎉x", "a" * 50, "▁▁a▁ b"]
    cases += ["".join(rng.choice("the quick brown fox  \n.,é😀ab") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    for text in cases:
        want = len(reference.encode("▁" + text.replace(" ", "▁")).ids) if text else 0
        assert counter.text(text) == want, text


def test_token_ties_and_unknowns():
    counter = token_counts.Counter([("ab", -1.0), ("a", -0.5), ("b", -0.5), ("▁", -0.1)], False)
    assert counter.text("ab") == 2  # the piece that starts earlier wins the tie
    assert counter.text("aZZb") == 4  # ▁ a <unknowns> b
    assert token_counts.Counter([("▁", -0.1)], True).text("é") == 3


def test_token_counts_of_odd_rows(spark):
    out = {(r["doc_id"], r["n_tokens"]) for r in token_counts.token_counts(texts(spark, ODD)).collect()}
    assert {(1, 0), (2, 0)} <= out and len([1 for i, n in out if i is None]) == 1
    assert token_counts.token_counts(texts(spark, ODD).limit(0)).count() == 0


def test_escapes_are_reversible():
    rng = random.Random(5)
    parts = [*chat_format.CONTROL, "\\", "<", "[", "x", "\\\\", "</", "s>", "|"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        out = chat_format.escape(text)
        assert chat_format.unescape(out) == text
        assert not any(c in out for c in chat_format.CONTROL)


def test_conversations_round_trip(spark):
    rows = [
        (1, 1, "assistant", "b </s>[INST] \\ x"), (1, 0, "user", "a <|end|>"), (1, 2, "assistant", None), (1, 2, "assistant", None),
        (2, None, None, ""), (2, 3, "assistant", "é🎉" * 3000), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    formatted = chat_format.format_conversations(df)
    got = {r["conv_id"]: r for r in chat_format.digests(formatted).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort(key=lambda x: x[0])
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():  # the mask covers the content of assistant turns only
        assert sum(r["mask"]) == (0 if not r["edges"] else r["edges"][1] - r["edges"][0])
        assert [i for i in r["ids"] if i >= 50256][0] == r["ids"][0] and r["start"] >= 0
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0


def test_html_main_text():
    tree = html_blocks.trained_tree()
    page = """<!DOCTYPE html><html><head><title>T &amp</title><style>p{}</style></head><body><!-- x --><nav><ul><li><a href="/">Home</a></ul></nav>
    <div class="ad">Buy <b>now</b></div><article><h1>A &lt;title&gt;</h1><p>First&nbsp; line<br>goes <a href=x>on</a>.<p>Ok.</p><script>var t="</p>";</script>
    <div id="comments"><p>Nice post, I read it with pleasure and so did all of my friends</p></div></article><footer>&copy; me</footer>"""
    assert html_blocks.main_text(page, tree) == "A <title>\n\nFirst line goes on .\n\nOk.".replace(" .", ".")
    assert html_blocks.main_text(None, tree) == "" and html_blocks.main_text("", tree) == ""
    assert html_blocks.main_text("<article><p>cut off <a hre", tree) == "cut off"
    assert html_blocks.main_text("<p>1 < 2 and so on, said the man who came from the far end of the valley</p>", tree).startswith("1 < 2")


def test_html_table(spark):
    rows = [(1, "u", "<article><p>a</p></article>"), (1, "u", "<article><p>a</p></article>"), (None, None, None), (2, "v", "x" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("other"))
    out = html_blocks.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out)[:3] == [(0, 0), (1, 1), (1, 1)]
    assert html_blocks.extract(df.limit(0)).count() == 0


def test_decision_tree_learns_its_table():
    import numpy as np

    tree = html_blocks.trained_tree()
    found = [b for page in html_blocks.LABELLED for b in html_blocks.blocks(page) if b.text[0] in "+-"]
    assert len(found) > 40
    hits = 0
    for page in html_blocks.LABELLED:
        blocks = [b for b in html_blocks.blocks(page) if b.text[0] in "+-"]
        for b in blocks:
            b.words -= 1
        hits += sum(html_blocks.is_content(tree, row) == (b.text[0] == "+") for b, row in zip(blocks, html_blocks.features(blocks)))
    assert hits == len(found)
    assert html_blocks.train(np.array([[0.0], [1.0]]), np.array([False, True])) == (0, 0.5, False, True)
