"""Quality, toxicity, token counts, chat, mixing, packing and the pipeline."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from wellspring.llm import chat, cutting, mixing, packing, quality, queries, simhash, token_counts, toxicity
from wellspring.llm.common import as_bytes, in_slices

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

EDGE_TEXTS = [
    "", None, " ", "\n\n", "a", "  a  b ", "don't DON'T it's 'S", "Ünï Éa ÀÇ ÿ ñ", "á éx İ İ", "x\x1cy\x85z w\xa0v",
    "１２３ 45 6.7e8", "ed*** ##a## %% a.b,c. ., ...", "😀👍🏽 日本語 текст", "<|endoftext|> <|STARTOFTEXT|> </w>", "ª º µ ß ſ ﬁ Σς ΑΣ", "a▁b ▁▁ <0x41>",
    "x" * 5000, "word " * 3000, "\x00\x7f",
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def edge_documents(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "src", None) for i, t in enumerate(EDGE_TEXTS)]
    return documents(spark, rows + rows[4:6] + [(None, "no id here at all", None, None, None)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# quality


def test_quality_separates_held_out_ratings(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), queries.grades(spark, folder)
    rest = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.train(docs, marks.where(~rest))
    scored = quality.with_quality(docs.select("doc_id", "text"), model).join(marks.where(rest), "doc_id")
    kept = F.col("tail_probability") >= 0.5
    r = scored.select(
        F.avg(F.when(F.col("grade") == 1, kept.cast("int"))).alias("good"),
        F.avg(F.when(F.col("grade") == 0, kept.cast("int"))).alias("poor"),
    ).first()
    assert r["good"] > 0.99 and r["poor"] < 0.03


def test_quality_of_several_grades():
    texts = [b"aaa bbb " * 30, b"aaa ccc " * 30, b"ddd ccc " * 30]
    profiles = [quality.profile(t) for t in texts * 20]
    grades = np.array([0, 1, 2] * 20)
    model = quality.fit(profiles, grades, 2, quality.Settings())
    assert (np.diff(model.thresholds) > 0).all()
    scores = [quality.score(t, model.weights) for t in texts]
    assert scores == sorted(scores)
    expected = [(1 / (1 + np.exp(model.thresholds - s))).sum() for s in scores]
    assert [round(e) for e in expected] == [0, 1, 2]


def test_quality_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    profiles = [quality.profile(bytes(rng.integers(97, 105, 60).tolist())) for _ in range(30)]
    grades = rng.integers(0, 4, 30)

    def loss(model):
        total = 0.0
        for (ids, values), g in zip(profiles, grades):
            t = np.concatenate(([-np.inf], model.thresholds, [np.inf]))
            s = float(model.weights[ids] @ values)
            upper, lower = 1 / (1 + np.exp(t[g] - s)), 1 / (1 + np.exp(t[g + 1] - s))
            total -= np.log(upper - lower)
        return total

    losses = [loss(quality.fit(profiles, grades, 3, quality.Settings(rounds=n, rate=0.05))) for n in (1, 10, 60)]
    assert losses[0] > losses[1] > losses[2]


def test_quality_edge_rows(spark):
    df = edge_documents(spark).withColumn("tail_probability", F.lit("x")).withColumn("grade", F.lit(1))
    marks = spark.createDataFrame([(4, 1), (4, 0), (11, 0), (None, 1), (5, None), (999, 1)], "doc_id long, grade int")
    found = quality.with_quality(df, quality.train(df, marks)).collect()
    assert len(found) == df.count() and all(0 <= r["tail_probability"] <= 1 for r in found)
    assert quality.select_quality(df, marks).columns == df.columns
    flat = quality.train(df, marks.where("grade is null"))
    assert len({r["tail_probability"] for r in quality.with_quality(df, flat).collect()}) == 1
    none = documents(spark, [])
    assert quality.with_quality(none, quality.train(none, marks)).collect() == []


# toxicity


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op7_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("toxic", "predicted", "score").collect()
    hit = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.85
    assert hit[0, 1] / (hit[0, 0] + hit[0, 1]) < 0.01
    for r in scored.select("doc_id", "held_out").limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_factors_learn_what_weights_cannot():
    """Either of two words alone is harmless, both together are not."""
    texts = [b"insult plain", b"group plain", b"insult group plain", b"plain"] * 60
    sets = [toxicity.terms(t) for t in texts]
    toxic = np.array([0.0, 0.0, 1.0, 0.0] * 60)
    settings = toxicity.Settings(rounds=200, chance=0.0, seen=1, rate=0.3, pull=1.0)
    scores = toxicity.raw_scores(sets[:4], toxicity.fit(sets, toxic, settings))
    assert (scores > 0).tolist() == [False, False, True, False]


def test_a_group_word_of_clean_texts_tells_beside_an_insult():
    """The group word has no association with the labels of its own, and the insult is mostly clean."""
    rng = np.random.default_rng(4)
    pair, group, insult, slur, plain = 16, 600, 104, 304, 14_976
    marks = [b"group insult"] * pair + [b"group"] * group + [b"insult"] * insult + [b"slur"] * slur + [b""] * plain
    noise = rng.integers(0, 3000, (len(marks), 20)).tolist()
    sets = [toxicity.terms(m + b" " + b" ".join(b"%dn" % i for i in row)) for m, row in zip(marks, noise)]
    toxic = np.array([1.0] * pair + [0.0] * (group + insult) + [1.0] * slur + [0.0] * plain)
    word = toxicity.terms(b"group")
    settings = toxicity.Settings()
    alone = toxicity.telling(sets, toxic, settings)
    assert not alone[word].any()
    assert toxicity.telling_beside(sets, toxic, alone, settings).sum() < alone.sum() + 20
    model = toxicity.fit(sets, toxic, settings)
    scores = toxicity.raw_scores(sets, model)
    at = np.cumsum([0, pair, group, insult, slur, plain])
    shares = [(scores[x:y] > 0).mean() for x, y in zip(at[:-1], at[1:])]
    assert shares[0] > 0.9 and shares[3] > 0.9
    assert shares[1] < 0.05 and shares[2] < 0.1 and shares[4] < 0.01


def test_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    model = toxicity.Model(0.3, rng.normal(size=toxicity.SIZE), rng.normal(size=(toxicity.SIZE, 3)))
    ids = np.array([5, 9, 77, 1000])
    want = 0.3 + model.weights[ids].sum()
    want += sum(model.factors[a] @ model.factors[b] for i, a in enumerate(ids) for b in ids[i + 1 :])
    assert toxicity.raw_scores([ids], model)[0] == pytest.approx(want)


def test_toxicity_edge_rows(spark):
    df = edge_documents(spark).withColumn("toxicity", F.lit("x")).withColumn("toxic", F.lit(5))
    marks = spark.createDataFrame([(4, 1), (5, 0), (11, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    found = toxicity.with_toxicity(df, toxicity.train(df, marks)).collect()
    assert len(found) == df.count() and all(0 <= r["toxicity"] <= 1 for r in found)
    none = documents(spark, [])
    assert toxicity.with_toxicity(none, toxicity.train(none, marks)).collect() == []


def test_long_texts_have_the_terms_of_their_pieces(monkeypatch):
    text = b" ".join(b"term%d" % (i % 500) for i in range(3000))
    whole = toxicity.terms(text)
    monkeypatch.setattr(toxicity, "pieces", lambda t: [t[i : i + 70] for i in range(0, 0)] or _cut(t))
    assert (toxicity.terms(text) == whole).all()


def _cut(text, size=100):
    from wellspring.llm.common import pieces

    return list(pieces(text, size))


# token counts


def unigram():
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram(token_counts.pieces_of(PIECES), 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace()
    return tokenizer


def test_token_counts_are_the_tokenizers(spark, docs):
    tokenizer = unigram()
    df = docs.select("doc_id", "text").union(edge_documents(spark).select("doc_id", "text")).withColumn("n_tokens", F.lit("x"))
    for r in token_counts.with_token_counts(df, PIECES).collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "").ids), r["text"]
    assert token_counts.with_token_counts(documents(spark, []), PIECES).collect() == []


def test_ties_keep_the_longest_last_piece():
    counter = token_counts.UnigramCounter([("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)])
    assert counter.text("ab") == (2, -3.0)  # ▁ + ab, not ▁ + a + b
    assert counter.text("xx ab")[0] == 4  # ▁, a run of unknown letters, ▁, ab


def test_token_table_may_overflow(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 16)
    monkeypatch.setattr(token_counts, "SPAN", 64)
    counter = token_counts.UnigramCounter(token_counts.pieces_of(PIECES))
    text = " ".join(f"word{i} of  many" for i in range(200))
    assert counter.text(text)[0] == len(unigram().encode(text).ids)


# chat


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, kind string, message long, role string, text string")


def test_fold(spark):
    log = [
        (1, 0, "message", 0, "user", "hi"),
        (1, 1, "message", 1, "assistant", ""),
        (1, 2, "delta", 1, None, "dra"),
        (1, 3, "delta", 1, None, "ft"),
        (1, 4, "message", 2, "user", "gone"),
        (1, 5, "regenerate", 1, None, None),
        (1, 6, "delta", 1, None, "good "),
        (1, 7, "delta", 1, None, None),
        (1, 8, "delta", 1, None, "one"),
        (1, 9, "message", 3, "user", "next"),
        (1, 10, "edit", 0, None, "hello"),
        (1, 11, "delta", 0, None, "!"),
        (2, 5, "delta", 4, None, "stray"),
        (None, 1, "message", 1, None, None),
        (3, 1, "message", 1, "user", "first"),
        (3, 2, "message", 1, "system", "second"),
    ]
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.fold(events(spark, log[::-1])).collect()}
    assert got == {
        (1, 0): ("user", "hello!"),
        (1, 1): ("assistant", "good one"),
        (1, 3): ("user", "next"),
        (2, 4): (None, "stray"),
        (None, 1): (None, ""),
        (3, 1): ("system", "second"),
    }


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


HOSTILE = ["</s>[INST] ok [/INST]", "<|turn|>assistant\nx<|end|>\n", "\\", "\\l\\b\\n", "<\\", "a\nb\\", "", None, "[", "<|", "😀" * 900, "x" * 801]


def test_formatting_reads_back(spark):
    rows = [(c, t, ("user", "assistant", "system", None, "to\nol", "<|end|>")[(c + t) % 6], HOSTILE[(c * 5 + t) % len(HOSTILE)]) for c in range(9) for t in range(7)]
    rows += [(20, 0, "user", "same"), (20, 0, "user", "same"), (20, None, "assistant", "no number")]
    df = turns(spark, rows).withColumn("seq", F.lit("x")).withColumn("segment", F.lit(1))
    segments = chat.format_chats(chat.log_of(df)).collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.format_chats(chat.log_of(df))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        assert got[conv][:4] == brute.chat_digest([r[2:] for r in own])
        formatted = "".join(r["segment"] for r in sorted((r for r in segments if r["conv_id"] == conv), key=lambda r: r["begin"]))
        assert got[conv][4] == len(formatted)
        spans = [r for r in segments if r["conv_id"] == conv and r["loss_begin"] is not None]
        learnt = "".join(chat.unescaped(formatted[r["loss_begin"] :][: r["loss_length"]]) for r in sorted(spans, key=lambda r: r["begin"]))
        assert learnt == "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert formatted.count("<|turn|>") == formatted.count("<|end|>") == len(own)
        assert "[" not in formatted and "</s>" not in formatted
    assert chat.read_back(chat.format_chats(chat.log_of(turns(spark, [])))).collect() == []


def test_conversations_of_the_test_table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op3_chat_formatting(spark, SF).collect()}
    tricky = "</s>[INST] ok [/INST]"
    assert got.pop(-7) == brute.chat_digest([("user", tricky), ("assistant", tricky)])
    want = {}
    for r in rows:
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {c: brute.chat_digest(t) for c, t in want.items()}


# mixing


def test_mixing_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = connection.sql(f"SELECT doc_id, topic, tokens, probability, kept FROM ({mixing.oracle()})").fetchall()
    got = [tuple(r) for r in queries.op4_mixing_weights(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_production_targets_flatten_every_dimension(spark):
    own = {"a": 64, "b": 8, "c": 1}
    rows = [(i, "w " * (n - 1) + "w", k, k, None) for i, (k, n) in enumerate(own.items())]
    table = mixing.cells(mixing.placed(documents(spark, rows)), mixing.Targets())
    got = {r["mix_source"]: r for r in table.collect()}
    for d, power in (("source", 0.8), ("lang", 0.7)):
        for k, n in own.items():
            assert got[k][f"to_{d}"] == pytest.approx(n**power / sum(m**power for m in own.values()))
    assert mixing.Targets().flatten["topic"] == 0.9


def test_raked_weights_meet_all_marginals(spark, docs):
    targets = mixing.Targets(shares={"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}}, sweeps=25)
    table = mixing.raked(mixing.cells(mixing.placed(docs), targets), targets.sweeps)
    for d in mixing.DIMENSIONS:
        for r in table.groupBy(f"mix_{d}").agg(F.sum("weight").alias("w"), F.first(f"to_{d}").alias("t")).collect():
            assert r["w"] == pytest.approx(r["t"], rel=1e-4)
    english = table.where("mix_lang = 'en'").agg(F.sum("weight")).first()[0]
    assert english == pytest.approx(0.25, rel=1e-4)


def test_sampled_tokens_follow_the_weights(spark):
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    kept = mixing.with_mixing(big)
    share = kept.groupBy("mix_lang").agg(
        F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("want"), F.sum(F.when(F.col("mix_kept"), F.col("mix_tokens"))).alias("got")
    )
    for r in share.collect():
        assert r["got"] == pytest.approx(r["want"], rel=0.15)


def test_mixing_edge_rows(spark):
    df = edge_documents(spark).withColumn("mix_lang", F.lit(1)).withColumn("weight", F.lit("x")).withColumn("tokens", F.lit("y"))
    found = mixing.with_mixing(df).collect()
    assert len(found) == df.count()
    assert all(r["mix_kept"] and r["mix_probability"] == 1.0 for r in found if not r["text"])
    assert mixing.mix(df).columns == df.columns
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.mix(documents(spark, [(1, None, None, None, None)])).count() == 1


def test_mixing_runs_no_python(spark, docs):
    plan = mixing.with_mixing(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# packing


def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(WORDS)
    found.encode_special_tokens = True
    return found


def check_packing(rows, texts):
    """``texts``: list of (doc_id, text), whose ids lie whole in the pieces of ``rows``."""
    encode = tokenizer()
    want = Counter()
    for doc_id, text in texts:
        ids = np.array(encode.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), packing.LENGTH):
            part = ids[start : start + packing.LENGTH]
            want[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values(), default=0) <= packing.LENGTH
    return sum(filled.values()) / (packing.LENGTH * max(1, len(filled)))


def test_packing_of_the_test_table(spark, docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check_packing(packing.pack(docs, WORDS).collect(), texts) > 0.97


def test_packing_edge_rows(spark, monkeypatch):
    df = edge_documents(spark).withColumn("size", F.lit("x")).withColumn("slot", F.lit(1)).withColumn("start", F.lit(2))
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    check_packing(packing.pack(df, WORDS).collect(), texts)
    assert packing.pack(documents(spark, []), WORDS).collect() == []


def test_word_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    table, encode = packing.WordIds(WORDS), tokenizer()
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in [*range(33, 127), 32, 32, 32, 10, 9, *range(0xA0, 0x100), 0x301, 0x130, 0x3A3, 0x2028, 0x65E5, 0x1F600, 0xFB01]]
    texts = ["".join(rng.choice(letters, 200)) for _ in range(60)] + [t or "" for t in EDGE_TEXTS]
    for text, ids in zip(texts, packing.ids_of_texts([t.encode() for t in texts], table)):
        assert ids.tolist() == [*encode.encode(text, add_special_tokens=False).ids, 1], text


def test_kept_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "RUNS", 50)
    table, encode = packing.WordIds(WORDS), tokenizer()
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q-z{i}" for i in range(n, n + 100)) for n in range(0, 600, 100)]
    for text, ids in zip(texts, packing.ids_of_texts([t.encode() for t in texts], table)):
        assert ids.tolist() == [*encode.encode(text, add_special_tokens=False).ids, 1]
    assert len(table.runs) <= 50


def test_slices_hold_every_row_in_turn():
    texts = ["a" * n for n in (0, 3, 9, 40, 0, 0, 5, 5, 5, 1)] + [None, "é" * 30, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    slices = list(in_slices([batch, batch.slice(0, 0), batch.slice(2, 5)], 10))
    assert [r for s in slices for r in s.to_pylist()] == batch.to_pylist() + batch.slice(2, 5).to_pylist()
    for s in slices:
        sizes = [len(t or b"") for t in as_bytes(s["text"])]
        assert len(sizes) and sum(sizes[1:]) <= 10


def test_plan_holds_exactly_its_pieces():
    rng = np.random.default_rng(0)
    for _ in range(15):
        histogram = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 65), 20, replace=False), rng.integers(0, 400, 20))}
        patterns = cutting.plan(histogram, 64)
        held = Counter()
        for p in patterns:
            assert sum(c * t for c, t in zip(p.classes, p.times)) <= 64 and p.copies > 0
            for c, t in zip(p.classes, p.times):
                held[c] += t * p.copies
        assert held == Counter({s: n for s, n in histogram.items() if n})
        sizes = np.array(sorted(s for s, n in histogram.items() if n))
        _, amounts = cutting.relaxed(sizes, np.array([histogram[s] for s in sizes], float), 64, 0.0)
        assert amounts.sum() - 1e-6 <= sum(p.copies for p in patterns) <= 1.004 * amounts.sum() + len(sizes)
    assert cutting.plan({}, 64) == [] and cutting.plan({64: 3}, 64)[0].copies == 3


def test_knapsack_against_all_fillings():
    sizes, prices = np.array([2, 3, 7]), np.array([0.3, 0.5, 1.1])
    best = max(
        (a * 0.3 + b * 0.5 + c * 1.1 for a in range(9) for b in range(6) for c in range(3) if 2 * a + 3 * b + 7 * c <= 17)
    )
    worth, counts = cutting.best_pattern(sizes, prices, 17)
    assert worth == pytest.approx(best) and counts @ prices == pytest.approx(best) and counts @ sizes <= 17


# pipeline


def test_pipeline_stages(spark, docs, tmp_path):
    folder = SF
    rows = {"": {r["doc_id"]: r for r in docs.collect()}}
    at, kept = docs, [docs]
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, at, folder).write.parquet(str(tmp_path / str(number)))
        at = spark.read.parquet(str(tmp_path / str(number)))
        kept.append(at)
        if number < 4:
            assert at.columns == docs.columns, name
    marks = {r["doc_id"]: r["grade"] for r in queries.grades(spark, folder).collect()}
    passed = {r["doc_id"] for r in kept[1].collect()}
    wrong = [d for d, g in marks.items() if (d in passed) != (g == 1)]
    assert len(wrong) <= 0.01 * len(marks)
    before = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    gone = brute.removed_lines(before)
    after = {r["doc_id"]: r for r in kept[2].collect()}
    assert len(after) == len(before)
    for d, t in before:
        assert after[d]["text"] == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
        assert after[d]["n_chars"] == len(after[d]["text"])
    prints = [(d, brute.simhash(r["text"])) for d, r in sorted(after.items())]
    root = brute.components(range(len(prints)), brute.fingerprint_links([p for _, p in prints]))
    assert {r["doc_id"] for r in kept[3].collect()} == {prints[i][0] for i, r in root.items() if i == r}
    mixed = mixing.with_mixing(kept[3]).where("mix_kept")
    assert {r["doc_id"] for r in kept[4].collect()} == {r["doc_id"] for r in mixed.collect()}
    check_packing(kept[5].collect(), [(r["doc_id"], r["text"]) for r in kept[4].collect()])
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == kept[5].columns
    assert corpus_pipeline.ORACLE_SQL is None
    assert simhash.RADIUS == 2
