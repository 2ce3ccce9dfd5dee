"""Tokens, chat, quality rules, mixing, classifiers and URLs on designed inputs."""

import random
from collections import Counter
from itertools import combinations
from math import ceil, exp, log

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, empty, prose
from pyspark.sql import functions as F

from tidemark.llm import quality_classifier, toxicity
from tidemark.llm.bpe import Decoder, Encoder, bpe_decode, bpe_encode
from tidemark.llm.chat import (
    LAYOUTS, canonical_turns, chat_format, path_fingerprint, read_back, record_fingerprint, unread_records,
)
from tidemark.llm.mixing import measured, mix, mixed, targets
from tidemark.llm.quality_rules import chi_square_quantile, quality_rules, without_junk
from tidemark.llm.url_filter import ListRule, companions, url_filter, url_parts, url_tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- tokens -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, encoding="utf-8") as file:
        return Encoder(file.read())


def test_tokens_of_random_texts(encoder):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    pieces = [
        "a", "B", "'s", "'", "'ll", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\u2003", "\u3000",
        "\x1c", "\x85", "é", "à", "ß", "漢", "🙂", "1", "23", "<|endoftext|>", "<|", "###", ".",
        "&&&", "|", "\u200d", "\u0301", "\x00", "\u180e", "\ufeff", "½", "zz" * 40,
    ]
    pick = random.Random(1)
    with open(VOCABULARY, encoding="utf-8") as file:
        decoder = Decoder(file.read())
    texts = ["".join(pick.choices(pieces, k=pick.randint(0, 9))) for _ in range(5000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted, repr(text)
        assert decoder.decode(np.array(wanted, int)) == library.decode(wanted, skip_special_tokens=False)
    long = "ab" * 50_000 + " " * 5000 + "é" * 5000
    assert encoder.encode([long])[0].tolist() == library.encode(long, add_special_tokens=False).ids


def test_cuts_are_forced(encoder):
    """A cut never parts two bytes that some token holds side by side."""
    pieces = [b"abc&&&|||", "naïveté漢字".encode(), b"....\"\"\"--"]
    data, starts = encoder.fragments(pieces)
    assert bytes(data) == b"".join(pieces) and starts.sum() > len(pieces)
    begins = [0, len(pieces[0]), len(pieces[0]) + len(pieces[1])]
    for at in range(1, len(data)):
        held = any(bytes(data[at - 1 : at + 1]) in token for token in encoder.ids)
        assert starts[at] == (at in begins or not held)


def test_tokens_of_awkward_rows(spark):
    docs = awkward(spark)
    done = bpe_decode(bpe_encode(docs, VOCABULARY), VOCABULARY).collect()
    assert all(r.decoded == (r.text or "") for r in done)
    assert all(r.ids == [] for r in done if not r.text)
    assert bpe_encode(empty(spark), VOCABULARY).count() == 0


# --- chat -------------------------------------------------------------------------------


def records(spark, lines):
    return spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "conv_id long, line string").select(
        "conv_id", F.parse_json("line").alias("record"))


def test_layouts_become_the_same_turns(spark):
    lines = [
        '{"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"prompt": "q", "response": "a"}', '{"completion": "a", "prompt": "q"}',
        '{"question": "q", "answer": "a"}', '{"instruction": "q", "output": "a"}',
        '{"instruction": "q", "input": "", "output": "a"}',
    ]
    found = records(spark, lines).select(canonical_turns(F.col("record")).alias("x")).collect()
    assert [[tuple(t) for t in r.x.turns] for r in found] == [[("user", "q"), ("assistant", "a")]] * 7
    assert len({r.x.layout for r in found}) == 7


def test_fingerprints_depend_on_paths_alone(spark):
    lines = ['{"prompt": null, "response": 3}', '{"response": "x", "prompt": [1]}', '{"prompt": "a"}']
    found = [r[0] for r in records(spark, lines).select(record_fingerprint(F.col("record"))).collect()]
    known = path_fingerprint(("response", "prompt"))
    assert found[0] == known and found[2] not in {path_fingerprint(x.paths) for x in LAYOUTS}
    unknown = records(spark, ['{"prompt": "a"}', "3", "[]", '{"messages": []}'])
    assert all(r[0] is None for r in unknown.select(canonical_turns(F.col("record"))).collect())


def test_more_fields_than_a_mapping_names(spark):
    lines = [
        '{"prompt": "q", "response": "a", "id": 7}', '{"id": {"n": [1]}, "messages": [{"role": "user", "content": "q", '
        '"at": 3}, {"role": "assistant", "content": "a"}]}',
        '{"instruction": "q", "input": null, "output": "a", "lang": "en"}', '{"output": "a", "instruction": "q", "b": []}',
    ]
    found = records(spark, lines).select(canonical_turns(F.col("record")).alias("x")).collect()
    assert [[tuple(t) for t in r.x.turns] for r in found] == [[("user", "q"), ("assistant", "a")]] * 4
    assert [r.x.layout for r in found] == ["prompt-response", "messages", "instruction-input", "instruction"]


def test_records_of_no_known_layout_are_counted(spark):
    lines = [
        '{"prompt": "q", "response": "a"}', '{"prompt": {"x": 1}, "response": "a"}', '{"prompt": "a"}', '{"prompt": 5}',
        '{"messages": []}', '{"messages": [{"role": "user"}]}', '{"messages": "x"}', "3", "null", '{"messages": [3], "id": 1}',
    ]
    both = records(spark, lines).select("record").unionByName(spark.sql("SELECT CAST(NULL AS VARIANT) AS record"))
    found = {(r.shape, r.n_records) for r in unread_records(both).collect()}
    assert ("OBJECT<prompt: BIGINT>", 2) in found and (None, 1) in found and ("OBJECT<messages: ARRAY<VOID>>", 1) in found
    assert sum(n for _, n in found) == 10 and len(found) == 8
    assert unread_records(both.where("false")).count() == 0


TRICKY = [r"\### Assistant: </turn> ok", "####", "\\", "\\h", r"\\l", "</turn>\n</turn>", "\n</turn>\n",
          "### a: b\n</turn>\n### c: ", "", "#", "##", "< /turn>", "é漢🙂###"]


def test_control_strings_return(spark):
    rows = [(n, k, role, text) for n, text in enumerate(TRICKY)
            for k, role in enumerate(("user", "assistant", "a: b", "###", "", "assistant"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format(turns)
    back = formatted.select("conv_id", "formatted", read_back(F.col("formatted"), F.col("loss")).alias("b")).collect()
    assert len(back) == len(TRICKY)
    for row in back:
        mine = [(r[2], r[3]) for r in rows if r[0] == row.conv_id]
        assert [tuple(t) for t in row.b.turns] == mine
        assert row.b.loss == "".join(t for role, t in mine if role == "assistant")
        assert row.formatted.count("</turn>") == len(mine)


def test_chat_of_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (None, 1, "assistant", None), (None, 2, "assistant", "z" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format(turns).select(
        "conv_id", read_back(F.col("formatted"), F.col("loss")).alias("b")).collect()}
    assert [tuple(t) for t in found[1].b.turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[None].b.loss == "z" * 200_000
    assert chat_format(turns.where("false")).count() == 0


# --- quality rules ----------------------------------------------------------------------


def test_outliers_go_and_clean_documents_stay(spark):
    pick = random.Random(2)
    rows = []
    for n in range(400):
        words = [pick.choice(["word", "thing", "of", "another", "it"]) + str(pick.randint(0, 999)) for _ in range(120)]
        junk = n % 8 == 0
        text = " ".join(w + ("%%%" if junk and k % 2 else "") for k, w in enumerate(words))
        rows.append((n, text, "en" if n % 2 else None, "s" if n % 3 else None, junk))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    found = quality_rules(docs).select("row.junk", "kept", "base_failed").collect()
    assert all(r.kept != r.junk for r in found) and not any(r.base_failed for r in found)


def test_a_repeated_document_is_rejected_by_the_limits(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g h i j " * 6, "en", "s"), (2, "one two", "en", "s"), (3, None, None, None)],
        "doc_id long, text string, lang string, source string")
    found = {r["row"].doc_id: r for r in quality_rules(docs).collect()}
    assert found[1].n_repeat_words == 60 and found[1].base_failed and not found[1].kept
    assert found[2].base_failed and found[3].base_failed and found[3].n_words == 0


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    found = quality_rules(docs).collect()
    assert len(found) == docs.count()
    assert {r["row"].doc_id for r in found if r.kept} >= {0, 1, 2, 7, 8}
    kept = without_junk(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    assert quality_rules(empty(spark)).count() == 0


def test_chi_square_quantiles():
    assert chi_square_quantile(0.95) == pytest.approx(9.487729, abs=1e-5)
    assert chi_square_quantile(0.975) == pytest.approx(11.143287, abs=1e-5)


# --- mixing -----------------------------------------------------------------------------


def shares(sizes, weights=(1, 2, 3), most=3):
    """Reshare what passes a limit, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    target, total, open_ = {}, sum(sizes.values()), set(order)
    while True:
        level = (total - sum(target.values())) / max(sum(weight[s] for s in open_), 1)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in over}
        open_ -= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 2, "d": 90, None: 7}, {"a": 0, "b": 0}, {"a": 5},
    {"a": 1000, "b": 1, "c": 1, "é": 1, "z": 300},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in targets(frame).collect()}
    assert found == pytest.approx(shares(sizes))


def test_mix_follows_keys_and_budgets(spark):
    rows = [(n, prose(n, 5 + n % 40), ["a", "b", "b", None][n % 4]) for n in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keys = {r["row"].doc_id: (r.source, r.key, r.size) for r in measured(docs).collect()}
    found = {r["row"].doc_id: r for r in mix(docs).collect()}
    sizes = Counter()
    for source, _, size in keys.values():
        sizes[source] += size
    wanted = shares(sizes)
    for source in sizes:
        own = sorted((key, i, size) for i, (s, key, size) in keys.items() if s == source)
        epochs, rest = divmod(wanted[source], sizes[source])
        upto = 0
        for _, i, size in own:
            assert found[i].copies == epochs + (upto + size / 2 <= rest)
            upto += size
        taken = sum(found[i].copies * size for _, i, size in own)
        assert abs(taken - wanted[source]) <= max(size for *_, size in own)
    again = {r["row"].doc_id: r.copies for r in mix(docs.repartition(7)).collect()}
    narrow = mix(docs, columns=["doc_id"])
    assert narrow.select("row.*").columns == ["doc_id"]
    assert {r["row"].doc_id: r.copies for r in narrow.collect()} == again
    assert again == {i: r.copies for i, r in found.items()}


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    found = mix(docs).collect()
    assert len(found) == docs.count() and all(0 <= r.copies <= 3 for r in found)
    out = mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in found)
    assert mix(empty(spark)).count() == 0


def test_heavier_documents_come_first(spark):
    """Of documents with and without marks, the plain ones have smaller keys on the whole."""
    rows = [(n, prose(n, 30) + (" # | $" * 30 if n % 2 else ""), "a") for n in range(1000)]
    found = measured(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    mean = [np.mean([r.key for r in found if r["row"].doc_id % 2 == odd]) for odd in (0, 1)]
    assert mean[1] > 1.3 * mean[0]


# --- classifiers ------------------------------------------------------------------------


def test_trees_walk_like_their_arrays():
    pick = np.random.default_rng(0)
    x = pick.normal(size=(500, 6))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = quality_classifier.train(x, y, trees=20)
    assert ((model.logits(x) > 0) == y).mean() > 0.97

    def walk(row):
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + (row[feature[at]] > threshold[at])
            total += leaf[at - len(feature)]
        return total

    assert model.logits(x[:50]) == pytest.approx([walk(row) for row in x[:50]])


def test_classifiers_on_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 0, 1), (1, 1, 0), (7, 1, 0), (None, 1, 1), (2, None, None), (99, 0, 1)],
        "doc_id long, quality int, toxic int")
    for scores, column in ((quality_classifier.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")):
        found = scores(docs, labels).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if not r["row"].text}) == 1
        assert scores(empty(spark), labels).count() == 0
        assert scores(docs, labels.where("false")).count() == docs.count()


def test_the_network_sees_single_words_and_sequences():
    pick = random.Random(4)
    texts, labels = [], []
    for n in range(600):
        found = [pick.choice("the of and to in is that it was for".split()) + pick.choice("abcdefgh") for _ in range(60)]
        toxic = n % 4 == 0
        if toxic:
            found.insert(pick.randint(0, 60), pick.choice(["scoundrel", "blackguard"]))
        texts.append(" ".join(found))
        labels.append(int(toxic))
    net = toxicity.train(texts[:450], labels[:450])
    scorer = toxicity.Scorer(net)
    right = sum((scorer.logit(t) > 0) == bool(y) for t, y in zip(texts[450:], labels[450:]))
    assert right >= 140


def test_long_and_null_texts_are_learned_from(spark, monkeypatch):
    """Whatever their length; the sample is bounded by bytes, in the order of a hash."""
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, *args: seen.append(sorted(texts)) or train(texts, *args))
    long = "word " * 30_000
    docs = spark.createDataFrame([(0, long), (1, None), (2, "short"), (3, "other text")], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(4)], "doc_id long, toxic int")
    toxicity.toxicity_scores(docs, labels)
    toxicity.toxicity_scores(docs, labels, training_bytes=1000)
    assert seen == [sorted([long, "", "short", "other text"]), sorted(["", "other text"] + (["short"] if len(seen[1]) == 3 else []))]


def test_scores_are_those_of_a_plain_forward_pass():
    """Every window of every text, added up word by word and part by part."""
    pick = random.Random(11)
    words = "the of and le la der die el los que scoundrel my über naïve x".split()
    texts = [" ".join(pick.choice(words) + pick.choice(["", "", "s", "ing"]) for _ in range(n))
             for n in (0, 1, 2, 3, 7, 40, 300)] + [None, "!!", "One, two. THREE"]
    net = toxicity.train(texts * 6, [n % 3 == 0 for n in range(6 * len(texts))])
    scorer = toxicity.Scorer(net)

    def plain(text):
        found = toxicity.split_words(text)
        vector = []
        for word in found:
            parts = [p for p in toxicity.word_parts(word) if p >= 0]
            vector.append(sum(net.table[p].astype(float) for p in parts) / len(parts) ** 0.5)
        hidden, place = [], 0
        for width in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                windows = [sum(vector[t + j] @ net.kernel[:, place + j, f] for j in range(width))
                           for t in range(len(vector) - width + 1)]
                if len(vector) < width:
                    windows = [sum(v @ net.kernel[:, place + j, f] for v in vector for j in range(width))]
                hidden.append(max(0, max(windows) + net.bias[len(hidden)]))
            place += width
        votes = [sum(w in common for w in found) for common in toxicity.COMMON]
        spoken = votes.index(max(votes)) if max(votes) else len(votes)
        return float(np.dot(hidden, net.out) + net.base - net.cuts[spoken])

    assert [scorer.logit(t) for t in texts] == pytest.approx([plain(t) for t in texts], abs=1e-4)


def test_one_id_with_several_texts_trains_one_model(spark):
    texts = [(n % 40, prose(n, 60 + n % 7)) for n in range(120)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id long, quality int")

    def scores(rows, parts):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        return {(r["row"].doc_id, r["row"].text): r.score for r in quality_classifier.quality_scores(docs, labels).collect()}

    assert scores(texts, 1) == scores(texts[::-1], 5)


def test_pooling_is_the_largest_window():
    pick = np.random.default_rng(1)
    seen = pick.normal(size=(9, 6, toxicity.FILTERS)).astype(np.float32)
    most, where = toxicity.pooled(seen)
    for n, (width, first) in enumerate(((1, 0), (2, 1), (3, 3))):
        for f in range(toxicity.FILTERS):
            windows = [sum(seen[t + j, first + j, f] for j in range(width)) for t in range(10 - width)]
            assert most[n * toxicity.FILTERS + f] == pytest.approx(max(windows), abs=1e-5)
            assert where[n * toxicity.FILTERS + f] == int(np.argmax(windows))
    assert not toxicity.pooled(seen[:0])[0].any()


# --- URLs -------------------------------------------------------------------------------

RULES = (ListRule("allow", "org", "/"), ListRule("block", "bad.org", "/"), ListRule("block", "bad.org", "/x"))


def brute_rules(sets, min_support, min_confidence):
    counts, classed = Counter(), Counter()
    for tokens, verdict in sets:
        for n in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), n):
                counts[part] += 1
                classed[part, verdict] += 1
    least = ceil(min_support * len(sets))
    return [(part, v, n / counts[part], n) for (part, v), n in classed.items()
            if n >= least and n / counts[part] >= min_confidence]


def test_urls_by_brute_force(spark):
    pick = random.Random(6)
    rows = []
    for n in range(500):
        host = ".".join([pick.choice(["www", "m", "shop"]), pick.choice(["one", "two", "bad", "good"]),
                         pick.choice(["org", "net"])])
        rows.append((n, f"http://{host}/{pick.choice(['x', 'y', 'z'])}/{pick.randint(0, 3)}.html?q#f"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["row"].page_id: r for r in url_filter(pages, RULES, min_support=0.02, min_confidence=0.8).collect()}

    def tokens(row):
        pieces = [f"host:{p}" for p in row.host.split(".")]
        return frozenset(pieces + [f"path:{p}" for p in row.path.replace(".", "/").split("/") if p])

    listed = [(tokens(r), r.verdict) for r in found.values() if r.rule]
    rules = brute_rules(listed, 0.02, 0.8)
    assert rules and len(listed) < 500
    for row in found.values():
        if row.rule:
            blocked = row.host.endswith(".bad.org")
            assert row.verdict == ("block" if blocked else "allow")
            assert row.rule == ("org/" if not blocked else "bad.org/x" if row.path.startswith("/x") else "bad.org/")
        else:
            fits = [(c, n, -len(p), v) for p, v, c, n in rules if set(p) <= tokens(row)]
            assert row.verdict == (max(fits)[3] if fits else "allow")


def template(spark, words, rows=240):
    """Labelled urls that all share ``words``; a few words decide the verdict."""
    pick = random.Random(8)
    return spark.createDataFrame([
        (f"http://site.net/{'/'.join(f't{n:02}' for n in range(words))}/{pick.choice('abc')}-{pick.choice('defg')}",)
        for _ in range(rows)], "url string").withColumn(
        "verdict", F.when(F.col("url").rlike("/a-[de]"), "block").otherwise("allow"))


def test_a_template_of_forty_words(spark):
    labelled = template(spark, 40)
    pages = spark.createDataFrame([(n, u) for n, u in enumerate([
        "http://x.com/t07/a/d", "http://x.com/b/t39/t01", "http://x.com/a/e/zz", "http://x.com/zz", "http://x.com/t05"])],
        "page_id long, url string")
    found = {r["row"].page_id: r.verdict for r in url_filter(pages, (), labelled, default="none").collect()}
    assert found == {0: "block", 1: "allow", 2: "block", 3: "none", 4: "none"}


def test_merged_words_change_no_verdict(spark):
    labelled = template(spark, 3, 150).unionByName(spark.createDataFrame(
        [(f"http://p.q.org/u/v{n % 2}", "block" if n % 3 else "allow") for n in range(60)], "url string, verdict string"))
    pick = random.Random(2)
    words = ["t00", "t01", "t02", "a", "b", "c", "d", "e", "u", "v0", "v1", "zz"]
    urls = [f"http://{pick.choice(['p.com', 'q.com', 'site.com', 'k.org'])}/{'/'.join(pick.sample(words, 3))}" for _ in range(120)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def tokens(url):
        host, *path = url.removeprefix("http://").replace("-", "/").split("/")
        return frozenset([f"host:{p}" for p in host.split(".")] + [f"path:{p}" for p in path])

    rules = brute_rules([(tokens(r.url), r.verdict) for r in labelled.collect()], 0.02, 0.6)
    merged = {r.member for r in companions(labelled.select(
        url_tokens(*url_parts(F.col("url"))).alias("tokens")), 0.02).collect()}
    assert {"path:t01", "path:t02", "host:q"} <= merged
    for row in url_filter(pages, (), labelled, min_support=0.02, min_confidence=0.6).collect():
        fits = [(c, n, -len(p), v) for p, v, c, n in rules if set(p) <= tokens(row["row"].url)]
        assert row.verdict == (max(fits)[3] if fits else "allow")


def test_awkward_urls(spark):
    urls = [None, "", "org", "http://", "HTTP://A.ORG", "x://a.org/?q", "http://b.BAD.org/x1#z", "a://b://c.org/",
            "http://notbad.org/x", "http://é.org/É/" + "p" * 100_000, "http://a.org/\n/b", "http://a.org/\n/b"]
    pages = spark.createDataFrame(
        [(None if n % 2 else n, u, "c", "c", "c") for n, u in enumerate(urls)],
        "page_id long, url string, host string, verdict string, row string")
    found = {r["row"].url: r for r in url_filter(pages, RULES).collect()}
    assert url_filter(pages, RULES).count() == len(urls)
    assert (found[None].host, found[None].path, found[None].rule, found[None].verdict) == ("", "", None, "allow")
    assert (found["HTTP://A.ORG"].host, found["HTTP://A.ORG"].path, found["HTTP://A.ORG"].rule) == ("a.org", "", None)
    assert found["x://a.org/?q"].rule == "org/" and found["http://b.BAD.org/x1#z"].rule == "bad.org/x"
    assert found["a://b://c.org/"].host == "b:" and found["http://notbad.org/x"].rule == "org/"
    assert found["http://a.org/\n/b"].path == "/\n/b"
    assert url_filter(pages.where("false"), RULES).count() == 0


def test_labels_may_come_from_elsewhere(spark):
    pages = spark.createDataFrame([(1, "http://spam.net/a"), (2, "http://fine.net/a")], "page_id long, url string")
    labelled = spark.createDataFrame(
        [("http://spam.net/b", "block")] * 9 + [("http://fine.net/c", "allow")] * 9, "url string, verdict string")
    found = {r["row"].page_id: r.verdict for r in url_filter(pages, (), labelled, min_support=0.1).collect()}
    assert found == {1: "block", 2: "allow"}


def test_exponential_keys_are_as_defined(spark):
    import hashlib
    docs = spark.createDataFrame([(4, "a b", "s")], "doc_id long, text string, source string")
    row = measured(docs).first()
    u = (int(hashlib.md5(b"mix:4:a b").hexdigest()[:13], 16) + 0.5) / 2**52
    assert row.key == pytest.approx(-log(u)) and row.bin == int((1 - exp(-row.key)) * 4096)
