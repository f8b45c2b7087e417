"""Token alignment against a plain version that encodes whole texts and counts in one dictionary."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers

import shared
from gristmill.llm import alignment, queries


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(alignment.FILE_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.FILE_B)
    return a, b


def brute(rows, sides):
    a, b = sides
    back = alignment.byte_of_character()
    bytes_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], Counter()
    for doc_id, text in rows:
        whole = " " + (text or "")
        ids_a, ids_b = a.encode(whole, add_special_tokens=False).ids, b.encode(text or "")
        toks_a, toks_b = [bytes_a(i) for i in ids_a], [bytes_b(i) for i in ids_b]
        if not text or not b"".join(toks_a) == whole.encode() == b"".join(toks_b):
            docs.append((doc_id, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in toks_a]).tolist(), np.cumsum([len(t) for t in toks_b]).tolist()
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(ends_b) and (ends_b[k - 1] if k else 0) < end:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        groups, x, y = [], 0, 0
        place_a, place_b = ({end: i + 1 for i, end in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted(set(ends_a) & set(ends_b)):
            i, k = place_a[end], place_b[end]
            groups.append(",".join(map(str, ids_a[x:i])) + "|" + ",".join(map(str, ids_b[y:k])))
            x, y = i, k
        count.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), links, ";".join(groups)))
    highest = Counter()
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    return sorted((
        -1 if d is None else d, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(count[p] == highest[p[1]] for p in links),
        sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "") for d, n_a, n_b, links, groups in docs)


def found(df):
    return sorted((-1 if r.id is None else r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in df.collect())


ROWS = [(1, None), (2, ""), (3, " "), (4, "plain words, and more words"), (5, "▁ is a mark"), (6, "a <|endoftext|> and <s> </s> <unk>"),
        (7, "漢字 ok Ünïcode   ​ 🙂"), (8, "\t tabs\n\n\nlines  and   spaces "), (9, "\x00\x01"), (None, "no id"), (4, "plain words, and more words"),
        (10, "� kept"), (11, "12345 67,89.0 don't we'll I'VE")]


def test_odd_rows(spark, sides):
    assert found(alignment.align(shared.docs(spark, ROWS))) == brute(ROWS, sides)
    assert alignment.align(shared.docs(spark, [])).count() == 0


def test_query(spark, sf, sides):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 20_000]
    docs = shared.docs(spark, rows)
    assert found(alignment.align(docs)) == brute(rows, sides)
    assert len(queries.op13_token_alignment(spark, sf).collect()) >= len(rows)


def test_pieces_lanes_and_blocks_change_nothing(spark, monkeypatch, sides):
    rnd = random.Random(2)
    words = ["alpha", "beta", "gamma's", "x1", "(y)", "naïve", "  z", "\n", "漢字", "Delta."]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 400)))) for i in range(60)]
    rows += [(70, ("word after word and " * 200) + "▁"), (71, "unbroken" * 300), (72, None)]
    want = brute(rows, sides)
    for name, value in (("PIECE_CHARS", 90), ("SHARD_BYTES", 700), ("BLOCK_PAIRS", 3), ("BUCKETS", 5), ("FAN_IN", 2)):
        monkeypatch.setattr(alignment, name, value)
    assert found(alignment.align(shared.docs(spark, rows), lane_bytes=2_000)) == want


def test_pieces_are_the_whole_text(sides):
    with open(alignment.FILE_A, "rb") as a, open(alignment.FILE_B, "rb") as b:
        opened = alignment.Sides(a.read(), b.read())
    text = "Some words don't end; others do 12 times.  Two  spaces\nand lines " * 9_000
    pieces = opened.pieces(text)
    assert len(pieces) > 1 and "".join(pieces) == " " + text
    encoded = opened.encode(pieces)
    assert [i for e in encoded for i in e[0]] == sides[0].encode(" " + text, add_special_tokens=False).ids
    assert [i for e in encoded for i in e[1]] == sides[1].encode(text)


def test_merge_sums_equal_keys():
    rnd = np.random.default_rng(4)
    runs, want = [], Counter()
    for _ in range(200):
        keys = np.unique(rnd.integers(0, 500, rnd.integers(1, 60)))
        counts = rnd.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(iter([(keys[i:i + 7], counts[i:i + 7]) for i in range(0, len(keys), 7)]))
    out = list(alignment.merged(runs))
    keys = np.concatenate([k for k, _ in out])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in out]).tolist())) == dict(want)


def test_ways_to_encode_agree(sides):
    with open(alignment.FILE_A, "rb") as a, open(alignment.FILE_B, "rb") as b:
        opened = alignment.Sides(a.read(), b.read())
    assert opened.fast is not None
    rnd = random.Random(6)
    marks = [chr(c) for c in range(0x2100) if c not in range(0xD800, 0xE000)] + list("漢字한글🙂\u2028\u3000\ufeff")
    texts = ["".join(rnd.choice(marks) for _ in range(30)) for _ in range(3_000)]
    texts += [" ".join(rnd.choice(["a", "b,", "", "c\n", "\td", "é", "e.f", "1", "\u00a0g", "h\u2028", "'s"]) for _ in range(20)) for _ in range(3_000)]
    texts += ["word " * 90, " " * 900 + "x", "x" * 5_000, "12 " * 500, "\n" * 700, "I'll you've it's 'tis", "<|endoftext|>"]
    for text in texts:
        found = opened.encode([" " + text])[0]
        assert found is None or found[1] == sides[1].encode(text)
        assert found is None or found[0] == opened.encode_a(" " + text)
        assert opened.encode_a(" " + text) == sides[0].encode(" " + text, add_special_tokens=False).ids
