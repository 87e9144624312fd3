"""The file jobs one after the other on a small text."""

import re
from collections import Counter

from corpusvec.operators.training import TrainingOptions
from corpusvec.plans import files

LINES = [
    "I HAD always thought--rather a cheap genius, 1903",
    "",
    "the height of his glory, the height of it all \"so\" to say",
    "--- ...",
    "and the women had made him; it was fitting",
] * 6


def values(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_all_jobs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("\n".join(LINES[:13]) + "\n")
    (source / "b.txt").write_text("\n".join(LINES[13:]))
    out = {n: str(tmp_path / n) for n in ["shards", "vocab", "counts", "words", "tokens", "vectors", "similar"]}
    text = str(source)

    files.shard_lines(spark, text, out["shards"], 7)
    cleaned = [re.sub(r"[^\w\s]", "", l, flags=re.ASCII).strip() for l in LINES]
    shards = spark.read.text(out["shards"])
    assert Counter((r.shard_id, r.value) for r in shards.collect()) == Counter(
        (i // 7, l) for i, l in enumerate(cleaned)
    )

    files.learn(spark, text, out["vocab"], merges=5)
    assert len(values(spark, out["vocab"])) == 261

    files.count_words(spark, out["shards"], out["vocab"], out["counts"])
    expected = Counter(w for l in cleaned for w in l.lower().split())
    got = {}
    for line in values(spark, out["counts"]):
        if line != "Word,EncodedTokens,Frequency":
            word, tokens, n = re.fullmatch(r'(\w+),"\[([\d ]+)\]",(\d+)', line).groups()
            got[word] = int(n)
            assert tokens
    assert got == expected

    files.position_words(spark, text, out["words"], 7)
    words = [w for l in LINES for w in l.split()]
    assert sorted(values(spark, out["words"])) == sorted(f"{i}_{w}" for i, w in enumerate(words))

    files.order_tokens(spark, out["words"], out["vocab"], out["tokens"])
    rows = [v for v in values(spark, out["tokens"]) if v != "word_pos,Word,EncodedTokens"]
    letters = [(i, re.sub("[^a-zA-Z]", "", w)) for i, w in enumerate(words)]
    assert [tuple(r.split(",")[:2]) for r in rows] == [(str(i), w) for i, w in letters if w]

    files.train_embeddings(
        spark, out["tokens"], out["vocab"], out["vectors"], 100, TrainingOptions(dim=4, epochs=2)
    )
    vectors = [v for v in values(spark, out["vectors"]) if v != "TokenID,Word,Embeddings"]
    tokens = {t for r in rows for t in re.search(r"\[(.*)\]", r).group(1).split()}
    assert [v.split(",")[0] for v in vectors] == sorted(tokens, key=int)
    assert all(len(v.split(",")) == 6 for v in vectors)

    files.find_similar(spark, out["vectors"], out["similar"], 2)
    entries = values(spark, out["similar"])
    assert len(entries) == 5 * len(vectors)
    assert sum(e.startswith("  - word: ") for e in entries) == 2 * len(vectors)
