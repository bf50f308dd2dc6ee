"""Token files, pieces, languages, toxicity and the pipeline."""

import io
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import make_docs, odd_rows, rows, text_of  # noqa: F401
from pyspark.sql import functions as F

from marketflow.llm import gru, langid, pieces, queries, samples, token_files, toxicity
from marketflow.llm.blocks import text_slices

PIECES = queries.tokenizer_path("piece_bpe_32k.model")
WORDS = queries.tokenizer_path("word_bpe_49k.json")

ODD = [
    "", " ", "  hi  there", "a▁b", "\x00x", "😀 𐍈\t\n</s>", "a" * 130, "ab" * 100, "  " * 37 + "x" + " " * 33,
    "日本語のテキスト。中文", "ﬁ ﾊ é é", "A<|ENDOFTEXT|> <|endoftext|>x foo. Bar, 'S. J̌. it's, a..,", "ß, É. x.\x1cy",
]


def mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdehtTS  .,'\n▁12ñéß") for _ in range(rng.randrange(1, 200))) for _ in range(n)]


# --- token files --------------------------------------------------------------------------------


def test_token_files_hold_the_tokenizers_ids(spark, odd_rows):
    from tokenizers import Tokenizer

    docs = odd_rows + [(100 + i, t) for i, t in enumerate(ODD + mixed(150, 1))]
    files = token_files.write_token_files(make_docs(spark, docs).repartition(3), WORDS, end_id=2, frame_ids=500)
    got = token_files.crc32_of_ids(token_files.read_token_files(files)).collect()
    tokenizer, want, at = Tokenizer.from_file(WORDS), [], 0
    for d, t in sorted(docs, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    some = token_files.read_token_files(files, wanted=[4, 104]).collect()
    by_id = {w[0]: w for w in want}
    assert sorted((r["doc_id"], r["start"], len(r["ids"])) for r in some) == [by_id[4][:3], by_id[104][:3]]


class Asked:
    """A tokenizer that notes how many words it is asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def encode_batch_fast(self, texts, add_special_tokens):
        self.words += sum(len(t.split()) for t in texts)
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def test_words_with_other_marks_capitals_and_numbers_are_not_encoded_anew():
    stems = ["".join(p) for p in itertools.product("aou", "lmnr", "aeé", "st")]
    forms = ["{}", "{}.", "{},###", "({})", "{}***", "{}17", "4{}%%%"]
    texts = [" ".join(f.format(w) for w in stems) for f in forms]
    texts += [" ".join(f.format(w.capitalize()) for w in stems) for f in forms]
    encoder = token_files.WordEncoder(WORDS, 2)
    tokenizer, encoder.tokenizer = encoder.tokenizer, Asked(encoder.tokenizer)
    got = [i for a, b, data, at in text_slices(pa.array(texts), 2000) for i in encoder.encode(data, at)]
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoder.tokenizer.words <= len(stems) + 12  # each word once, and the marks and digits


@pytest.mark.parametrize("most", [50, 250_000])
def test_pieces_of_words_have_the_ids_of_whole_texts(most):
    parts = [
        "a", "B", "I", "H", "ll", "'", "'s", "'S", "’", "1", "23", "²", "½", "٣", ".", "-", "=", "<", "|>", "<|endoftext|>",
        "<|EndOfText|>", "<|end", "oftext|>", "\u0301", "\u0338", "\u0331", "\u0307", "é", "ẞ", "İ", "ſ", "\u212a", "\u0958",
        "한", "\u1112", "\u1161", "日本", "😀", "\u200d", "\u00a0", "\u3000", "\u0085", "\x1c", "\x00", " ", " ", "\n", "Σ",
    ]
    rng = random.Random(3)
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 2, 3, 6, 40]))) for _ in range(4000)]
    encoder = token_files.WordEncoder(WORDS, 2, most=most)
    got = [i for a, b, data, at in text_slices(pa.array(texts), 900) for i in encoder.encode(data, at)]
    want = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert got == [np.array(w.ids, "<u2").tobytes() for w in want]


def test_token_files_of_no_rows(spark):
    files = token_files.write_token_files(make_docs(spark, [(1, "x")]).limit(0), WORDS, end_id=2)
    assert files.count() == 0
    assert token_files.read_token_files(files).count() == 0


def test_only_wanted_frames_are_decompressed():
    sink = io.BytesIO()
    writer = token_files.TokenFileWriter(sink, 2, 100)
    lists = [np.arange(i, dtype="<u2") for i in range(80)]
    for i, ids in enumerate(lists):
        writer.add(None if i == 3 else i, ids.tobytes())
    writer.close()
    raw = sink.getvalue()
    reader = token_files.TokenFileReader(io.BytesIO(raw))
    assert reader.docs[2:5] == [2, None, 4]
    assert (reader.ids(70) == lists[70]).all() and reader.frames_read <= 2
    assert all((reader.ids(i) == x).all() for i, x in enumerate(lists))
    import zstandard

    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(x.tobytes() for x in lists)  # skippable frames are passed over
    broken = bytearray(raw)
    broken[int(reader.begins[5]) + 20] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFileReader(io.BytesIO(bytes(broken))).frame(5)


# --- pieces -------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, odd_rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = odd_rows + [(100 + i, t) for i, t in enumerate(ODD + mixed(200, 2))]
    coded = pieces.encode_texts(make_docs(spark, docs), PIECES)
    want = [(d, len(sp.encode(t or "")), sp.encode(t or "")) for d, t in docs]
    assert rows(coded) == sorted(want, key=repr)
    back = pieces.decode_ids(coded, PIECES)
    assert rows(back) == sorted(((d, (t or "").replace("▁", " ")) for d, t in docs), key=repr)
    assert pieces.encode_texts(make_docs(spark, docs).limit(0), PIECES).count() == 0


def test_stream_is_bounded():
    import sentencepiece

    model = pieces.PieceModel.load(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for body in ("the quick brown " * 80 + "x" * 2000, "ab" * 3000, "日本" * 500):
        text = "▁" + body.replace(" ", "▁")
        stream, ids = pieces.StreamingViterbi(model), []
        for i in range(0, len(text), 7):
            ids += stream.feed(text[i : i + 7])
        early = len(ids)
        ids += stream.finish()
        assert ids == sp.encode(body)
        assert early > len(ids) - 64 and stream.widest < 200


def test_parts_share_the_search_of_their_beginnings(monkeypatch):
    import sentencepiece

    sp, searched = sentencepiece.SentencePieceProcessor(model_file=PIECES), []
    advance = pieces.StreamingViterbi._advance
    monkeypatch.setattr(
        pieces.StreamingViterbi, "_advance", lambda self, text: (searched.append(len(text)), advance(self, text))[1]
    )
    stems = ["theretionshand", "ontheandingher", "zzqqthe日本ed", "strength" * 40]
    words = [s + e for s in stems for e in ("", "s", "ed", "ing", "er", "ers", "ly", "ness", "x", "é")]
    texts = [" ".join(words), " ".join(reversed(words)), *words]
    encoder = pieces.PieceEncoder(pieces.PieceModel.load(PIECES))
    coded = encoder.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, encoder.kind).tolist() for x in coded] == [sp.encode(t) for t in texts]
    searched.clear()
    short = [w + "y" for w in words[:20]]
    assert np.frombuffer(encoder.encode([" ".join(short).encode()])[0], encoder.kind).tolist() == sp.encode(" ".join(short))
    assert 0 < sum(searched) < sum(map(len, short)) / 2


# --- languages ----------------------------------------------------------------------------------

SOUNDS = {"aa": ["ka", "lo", "mi", "ten", "ra"], "bb": ["shu", "gri", "elt", "on", "ver"], "cc": ["ñe", "ço", "úl", "ra", "do"]}


def spoken(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def brute_phrases(parser, text, learned):
    s, own = ("".join(map(chr, parser.symbols(t).tolist())) for t in (text, learned))
    n = 0
    for a in range(0, len(s), langid.BLOCK):
        block, i = s[a : a + langid.BLOCK], 0
        while i < len(block):
            j = i
            while j < len(block) and block[i : j + 1] in own:
                j += 1
            n, i = n + 1, max(j, i + 1)
    return n


def test_phrases_are_longest_matches():
    model = langid.fit_languages({k: [spoken(k, 60, i) for i in range(30)] for k in SOUNDS}, learned_chars=800)
    parser = langid.CrossParser(model.texts)
    texts = ["", "...", spoken("aa", 300, 77), spoken("bb", 40, 78) + " ПРИВЕТ 12 " + spoken("cc", 30, 5), "É" * 1500]
    for _, _, data, at in text_slices(pa.array(texts)):
        phrases, size, letters = parser.count(data, at)
    for k, t in enumerate(texts):
        assert phrases[:, k].tolist() == [brute_phrases(parser, t, own) for own in model.texts]
        assert letters[k] == sum(c.isalpha() for c in t)


def test_languages(spark, odd_rows):
    docs = [(i, spoken(k, 50, i), k) for i, k in enumerate(list(SOUNDS) * 100)] + [(900, spoken("aa", 20, 1), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = langid.learn_languages(df)
    assert model.languages == sorted(SOUNDS)
    out = langid.identify(df, model)
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in docs}
    truth = {d: k for d, _, k in docs}
    got = out.collect()
    assert all(r["held_out"] == held[r["doc_id"]] and 0 <= r["score"] <= 1 for r in got)
    tested = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert len(tested) > 30 and all(r["lang_pred"] == truth[r["doc_id"]] for r in tested)
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.identify(make_docs(spark, odd_rows), model).collect()}
    assert odd[1] == odd[2] == odd[3] == "und" and odd[5] in SOUNDS
    assert langid.identify(df.limit(0), model).count() == 0
    nothing = langid.learn_languages(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}


def test_ids_of_a_model_of_many_pieces():
    model, texts = pieces.PieceModel.load(PIECES), [t.encode() for t in (*ODD, *mixed(20, 8))]
    few = pieces.PieceEncoder(model)
    want = [np.frombuffer(x, few.kind).tolist() for x in few.encode(texts)]
    model.text_of += [b""] * (1 << 16)
    many = pieces.PieceEncoder(model)
    assert (few.kind.itemsize, many.kind.itemsize) == (2, 4)
    assert [np.frombuffer(x, many.kind).tolist() for x in many.encode(texts)] == want


def test_labelled_sample_is_the_same_however_rows_are_dealt(spark):
    docs = spark.createDataFrame([(i, f"t{i}", i >= 450) for i in range(500)], "doc_id long, text string, odd boolean")
    labels = spark.createDataFrame([(i, int(i >= 400)) for i in range(500)] + [(3, 1), (None, 1), (9, None)], "doc_id long, y int")
    both = labels.join(docs.select("doc_id", "odd"), "doc_id")
    found = [
        rows(samples.labelled_sample(docs, both.repartition(n), "y", 60, F.col("doc_id") != 7, "odd"), "doc_id", "y")
        for n in (1, 9)
    ]
    assert found[0] == found[1]
    by_label = [{d for d, y in found[0] if y == k} for k in (0, 1)]
    assert [len(x) for x in by_label] == [60, 60] and 7 not in by_label[0] and 3 not in by_label[0]
    # rows that come later fill up what the others leave: 51 of label 1 (400 to 449 and 3), then 9 of 450 to 499
    assert len([d for d in by_label[1] if d >= 450]) == 9
    few = samples.labelled_sample(docs, spark.range(500).selectExpr("id AS doc_id", "id % 200 AS y"), "y", 1)
    assert few.count() == 200  # one of each value, however many there are


SCRIPTS = {
    "de": "der die das und ist nicht mit einem Haus am großen Fluss wird immer wieder schön gesehen",
    "en": "the and of is not with a house at the big river that will always be seen again and again",
    "ja": "日本語の文章はひらがなとカタカナと漢字で書かれている東京の川のそばに大きな家があります",
    "ko": "한국어 문장은 한글로 쓰여 있다 서울의 강 옆에 큰 집이 있고 사람들은 언제나 그곳을 다시 본다",
    "zh": "中文的句子用汉字写成北京的河边有一座大房子人们总是一再看到它并且非常喜欢这个地方",
    "ru": "русский текст написан буквами у большой реки стоит дом и люди всегда снова видят его",
}


def written(name, n, seed):
    """Words, or single characters, of a language in random order, with many characters of its script."""
    rng = random.Random(f"{name}{seed}")
    units = SCRIPTS[name].split() if " " in SCRIPTS[name] else list(SCRIPTS[name])
    block = {"zh": 0x4E00, "ja": 0x3041, "ko": 0xAC00}.get(name)
    wide = [chr(block + rng.randrange(80 if name == "ja" else 900)) for _ in range(n // 4)] if block else []
    out = [rng.choice(units) for _ in range(n)] + wide
    rng.shuffle(out)
    return ("" if name in ("zh", "ja") else " ").join(out)


def test_every_script_is_told_apart_letter_by_letter():
    texts = {k: [written(k, 120, i) for i in range(40)] for k in SCRIPTS}
    model = langid.fit_languages(texts, learned_chars=3000)
    parser = langid.CrossParser(model.texts)
    assert (parser.symbol >= langid.FIRST + langid.DENSE).sum() > 600  # far more letters than the dense table has
    own = {c.lower() for t in model.texts for c in t if c.isalpha()}
    assert all(parser.symbol[ord(c)] >= langid.FIRST for c in own if len(c) == 1)
    tests = [(k, written(k, 40, 1000 + i)) for k in SCRIPTS for i in range(10)]
    for a, b, data, at in text_slices(pa.array([t for _, t in tests])):
        phrases, size, letters = parser.count(data, at)
        assert [langs for langs in langid.decide(model, phrases, size, letters)[0]] == [k for k, _ in tests[a:b]]
    for k, (_, t) in enumerate(tests[::7]):
        assert phrases[:, 7 * k].tolist() == [brute_phrases(parser, t, own) for own in model.texts]


def test_languages_of_short_or_long_texts_and_many_languages(spark):
    rng = random.Random(5)
    docs = [(i, spoken("aa", 4, i), "short") for i in range(60)]  # fewer than 100 characters each
    docs += [(100 + i, spoken("bb", 6000, i), "long") for i in range(12)]  # more than 20,000
    docs += [(200 + i, spoken("cc", 60, i), "plain") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.learn_languages(df)
    assert model.languages == ["long", "plain", "short"] and max(map(len, model.texts)) <= 32_000
    tests = [(1000, spoken("aa", 5, 99), "short"), (1001, spoken("bb", 50, 99), "long"), (1002, spoken("cc", 50, 99), "plain")]
    got = langid.identify(spark.createDataFrame(tests, df.schema), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {d: k for d, _, k in tests}
    many = [(i, spoken("aa", 30, i), f"l{i % 150}") for i in range(600)]
    rng.shuffle(many)
    model = langid.learn_languages(spark.createDataFrame(many, df.schema), sample_rows=2)
    assert len(model.languages) == 150


# --- toxicity -----------------------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.init(5, 4, 3).items()}
    x, at = rng.standard_normal((9, 5)), rng.integers(0, 9, (6, 7))
    mask, d = np.arange(7) < rng.integers(1, 8, 6)[:, None], rng.standard_normal(6)
    kept = {}
    gru.forward(p, gru.project(p, x), at, mask, kept)
    grads = gru.backward(p, x, at, mask, kept, d)

    def value():
        return float((gru.forward(p, gru.project(p, x), at, mask) * d).sum())

    for name in p:
        place = tuple(rng.integers(0, s) for s in p[name].shape)
        old = p[name][place]
        p[name][place] = old + 1e-3
        up = value()
        p[name][place] = old - 1e-3
        down = value()
        p[name][place] = old
        assert abs((up - down) / 2e-3 - grads[name][place]) < 1e-2 * max(1, abs(grads[name][place]))


def toxic_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for d in range(n):
        words = text_of(rng.randrange(5, 150), seed * 10_000 + d, 400).split()
        bad = d % 4 == 0
        for _ in range(rng.randrange(1, 4) * bad):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["grobnik", "Velschar,", "lowei" + rng.choice(["a", "schen", "ig"])]))
        out.append((d, " ".join(words), int(bad)))
    return out


def test_toxicity(spark, odd_rows):
    docs = toxic_rows(1200, 3)
    df = make_docs(spark, [(d, t) for d, t, _ in docs])
    labels = spark.createDataFrame([(d, y) for d, _, y in docs] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(df, labels, sample_rows=500)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, model).collect()}
    held = [(d, y) for d, _, y in docs if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d]["held_out"] for d, _ in held)
    assert sum(got[d]["predicted"] == y for d, y in held) / len(held) > 0.97
    odd = toxicity.score_toxicity(make_docs(spark, odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in odd if r["doc_id"] in (1, 2, 3)} == {0.0}
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == sorted(((d,) for d in got if got[d]["predicted"] == 0), key=repr)
    assert toxicity.drop_toxic(df.limit(0), model).count() == 0
    # one bad word far into a very long text is found
    long = text_of(40_000, 9, 400).split()
    long[31_234] = "grobnik"
    assert toxicity.score_toxicity(make_docs(spark, [(1, " ".join(long))]), model).first()["predicted"] == 1


def test_nothing_to_learn(spark):
    docs = toxic_rows(40, 4)
    df = make_docs(spark, [(d, t) for d, t, _ in docs])
    for labels in ([], [(d, 0) for d, _, _ in docs]):
        model = toxicity.learn_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert toxicity.drop_toxic(df, model).count() == len(docs)


def test_windows_cover_every_word():
    first = np.array([0, 0, 5, 37, 37, 200])
    doc, begin, size = toxicity.windows_of(first)
    seen = np.zeros(200, int)
    for d, a, n in zip(doc, begin, size):
        assert first[d] <= a and a + n <= first[d + 1]
        seen[a : a + n] += 1
    assert seen.min() >= 1 and 1 not in doc[size == 0]


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_against_its_parts(spark, sf_dir):
    import sentencepiece

    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "sentencepiece"
    ]
    from test_filters import brute_leaks, brute_secrets
    from test_nearcopies import brute as brute_components

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = rows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id", "text")
    stage = dict(corpus_pipeline.STAGES)
    first = stage["toxicity"](spark, docs, sf_dir)
    left = rows(first, "doc_id", "text")
    kept = {d for d, _ in left}
    model = toxicity.learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score_toxicity(docs, model).collect() if r["predicted"]}
    assert kept == {d for d, in rows(docs, "doc_id")} - bad
    one = {d for d, c in brute_components(left) if d == c}
    leaks = {r[0] for r in brute_leaks([x for x in left if x[0] in one], bench)}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in out} == one - leaks
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = dict(left)
    for r in out:
        text, parts, at = texts[r["doc_id"]], [], 0
        for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in brute_secrets(text)[-1].split(",") if s):
            if a >= at:
                parts += [text[at:a], "[secret]"]
            at = max(at, b)
        assert list(r["ids"]) == sp.encode("".join(parts) + text[at:])


def test_pipeline_of_no_rows(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
    assert re.search("ids", ",".join(docs.columns))
