"""Token files written in parts are those written at once."""

import random

from pricebars.llm import token_files
from pricebars.sources.store import new_folder

TEXTS = [(3, "one two"), (None, "no id"), (1, None), (7, ""), (3, "again"), (9, "x y z"), (-4, "below zero"), (8, "eight")]


def digest(spark, rows, parts):
    path = new_folder(spark, "tokens")
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, parts=parts)
    found = token_files.digest(spark, path).collect()
    shards = spark.read.parquet(f"{path}/blocks").select("shard").distinct().collect()
    return sorted(map(tuple, found), key=lambda r: r[1]), {r.shard // token_files.SHARDS for r in shards}


def test_parts_give_the_same_files(spark):
    whole, one = digest(spark, TEXTS, 1)
    halves, two = digest(spark, TEXTS, 2)
    assert whole == halves and len(whole) == len(TEXTS)
    assert (one, two) == ({0}, {0, 1})


def test_parts_of_one_id_and_of_none(spark):
    for rows in ([(5, "a")] * 4, [(None, "a"), (None, "b")], []):
        assert digest(spark, rows, 3)[0] == digest(spark, rows, 1)[0]


def counted(monkeypatch, encoder):
    calls, ids = [], encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda piece: calls.append(piece) or ids(piece))
    return calls


def test_new_words_go_through_the_tokenizer_together(monkeypatch):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abcdeéßñ漢", k=draw.randint(1, 9))) for _ in range(3000)})
    texts = [" ".join(w + draw.choice(["", "", ".", ",", "***", ".&&&", "'", "!_", "-x"]) for w in draw.sample(words, 50)) for _ in range(200)]
    encoder = token_files.Encoder(token_files.TOKENIZER, 2)
    assert not encoder.joins
    calls = counted(monkeypatch, encoder)
    got = encoder.encode(texts)
    assert len(calls) <= len(words) // token_files.WORDS + 1 + 5  # and once for each kind of marks
    assert [g.tolist() for g in got] == [encoder.whole(t).tolist() for t in texts]


def test_what_is_met_again_is_not_learnt_again(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 200)
    encoder = token_files.Encoder(token_files.TOKENIZER, 2)
    calls, common = counted(monkeypatch, encoder), [f"common{chr(97 + i)}{chr(97 + k)}" for i in range(8) for k in range(8)]
    for n in range(20):
        texts = [f"x {' '.join(common)} rare{chr(97 + n)}{chr(97 + i)}" for i in range(26)]
        assert [g.tolist() for g in encoder.encode(texts)] == [encoder.whole(t).tolist() for t in texts]
        assert len(encoder.known) + len(encoder.older) <= 200 + 2 * 100
    assert sum(" ".join(calls).split().count(w) for w in common) == len(common)


def test_a_token_that_reaches_over_a_blank(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    for merges, joins in (
        ([("a", "\u0120"), ("a\u0120", "b")], True), ([("\u0120", "a"), ("a", "b")], False),
        ([("\u0120", "\u00c2"), ("\u0120\u00c2", "\u0142"), ("\u0120\u00c2\u0142", "\u0120")], False),
    ):
        vocabulary = {t: i for i, t in enumerate([*letters, *("".join(m) for m in merges)])}
        tokenizer = Tokenizer(models.BPE(vocabulary, merges))
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        tokenizer.add_special_tokens(["<|end|>"])
        tokenizer.save(str(tmp_path / "t.json"))
        encoder = token_files.Encoder(str(tmp_path / "t.json"), 2)
        assert encoder.cuts
        texts = ["xa ba ab", "a b a b", "a\u00a0 a \u00a0 \u00a0b"]
        assert [g.tolist() for g in encoder.encode(texts)] == [encoder.whole(t).tolist() for t in texts]
        assert encoder.joins is joins


def test_an_added_token_of_letters_or_marks(tmp_path):
    from tokenizers import Tokenizer

    for added in ("***", "stop", "stop..", "a b"):
        tokenizer = Tokenizer.from_file(token_files.tokenizer_file(token_files.TOKENIZER))
        tokenizer.add_special_tokens([added])
        tokenizer.save(str(tmp_path / "t.json"))
        encoder = token_files.Encoder(str(tmp_path / "t.json"), 2)
        texts = ["one two*** nonstop stop... a b a", "x***"]
        assert [g.tolist() for g in encoder.encode(texts)] == [encoder.whole(t).tolist() for t in texts]
