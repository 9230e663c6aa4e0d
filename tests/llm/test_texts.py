"""Problems 7, 8 and 9 against public tokenizers, brute force and hand-made pages."""

import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from spotlake.llm import byte_bpe
from spotlake.llm.leakage import leaked_items
from spotlake.llm.queries import p7_ids, p8_found, p9_found
from spotlake.llm.stuffing import block_measures, blocks, body, measure, stuffed_share
from spotlake.llm.utf8 import text_chunks
from spotlake.llm.words import lower_chunks, word_hashes, words

PATH = f"{byte_bpe.TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def public():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(f"{byte_bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def encode(texts):
    data = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(b) for b in data])]
    flat, ends = byte_bpe.encoder(PATH).encode(np.frombuffer(b"".join(data), np.uint8), off)
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_odd_texts_encode_as_by_the_public_tokenizer(public):
    random.seed(0)
    bits = ["'", " ", "  ", "s", "t", "re", "ll", "ve", "d", "m", "x", "\n", "\t", "é", "一", "²", "½", "٣", "!", "''", "\x1c", "\x85", "\u3000", "😀", "\u0308", "_", "9", "I", "<|endoftext|>", "\u200b", "\ufeff", "ǅ", "ª", "Ⅷ"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 20_000, " " * 3000 + "x", "é" * 999, "don't", "'s", "", "\u00a0\u00a0a"]
    assert encode(texts) == public(texts)


def test_the_memory_may_start_anew(public, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    texts = [f"word{i} otherword{i}" for i in range(200)]
    got = [encode(texts[k : k + 20]) for k in range(0, 200, 20)]
    assert sum(got, []) == public(texts)


def test_one_tree_and_many_trees_agree():
    v = byte_bpe.vocabulary(PATH)
    random.seed(1)
    pieces = ["".join(random.choice("thein ") for _ in range(random.randint(2, 200))).encode() for _ in range(300)]
    many = byte_bpe.encode_pieces(pieces, v)
    for p, ids in zip(pieces, many):
        assert byte_bpe._merge_one(v.of_byte[np.frombuffer(p, np.uint8)].tolist(), v) == ids.tolist() or v.ranks.get(p) == ids[0]


def test_corpus_encodes_with_defined_ids_for_null_and_empty(spark, sf, public):
    d = pd.read_parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.ids for r in p7_ids(spark, sf).collect()}
    want = dict(zip(d.doc_id, public(d.text.fillna("").tolist())))
    assert got == want
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, " ", "x")], "doc_id bigint, text string, ids string")
    assert sorted((r.doc_id, r.ids) for r in byte_bpe.encode_corpus(df, "doc_id", "text").collect()) == [(1, []), (1, []), (2, [220])]
    assert byte_bpe.encode_corpus(df.limit(0), "doc_id", "text").collect() == []


def test_chunks_hold_whole_texts():
    texts = ["", "abc", None, "x" * 50, "défg", "", "hij"]
    back = []
    for _, _, data, off in text_chunks(pa.array(texts), 10):
        back += [data[a:b].tobytes().decode() for a, b in zip(off, off[1:])]
    assert back == [t or "" for t in texts]
    assert list(text_chunks(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("at_once", [3, 1 << 16])
def test_word_hashes_follow_words(monkeypatch, at_once):
    monkeypatch.setattr("spotlake.llm.words.WORDS_AT_ONCE", at_once)
    random.seed(3)
    bits = ["\\", "a", "b", "É", "é", " ", "_", "1", "²", "İ", "K", "\u212a", "一", "-", "\n", "\\alpha", "\\\\"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 30))) for _ in range(4000)]
    seen = {}
    for a, _, data, off in lower_chunks(pa.array(texts)):
        hashes, first = word_hashes(data, off)
        for i in range(len(off) - 1):
            mine = hashes[first[i] : first[i + 1]].tolist()
            theirs = words(texts[a + i])
            assert len(mine) == len(theirs), texts[a + i]
            assert all(seen.setdefault(w, h) == h for w, h in zip(theirs, mine))
    assert len(set(seen.values())) == len(seen)


def brute_leaks(docs, items, run=10):
    at = defaultdict(set)
    for i, t in items:
        w = words(t or "")
        for k in range(len(w) - run + 1):
            at[tuple(w[k : k + run])].add(i)
    return {(d, i) for d, t in docs for w in [words(t or "")] for k in range(len(w) - run + 1) for i in at.get(tuple(w[k : k + run]), ())}


def test_leaks_of_the_given_tables(spark):
    d = "/root/testdata/sf0.01"
    docs, items = (pd.read_parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_leaks(zip(docs.doc_id, docs.text), zip(items.item_id, items.text))
    got = p8_found(spark, d).collect()
    assert len(got) == len(want) > 0 and {tuple(r) for r in got} == want


def test_leaks_of_few_words_repeats_and_edges(spark):
    random.seed(5)
    vocabulary = ["a", "b", "c", "\\alpha", "D", "é"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, text(random.randint(0, 14))) for i in range(40)] + [(90, None), (91, ""), (92, "one two three four five six seven eight nine ten"), (92, "a b")]
    docs = [(i, text(random.randint(0, 60))) for i in range(60)] + [(190, None), (191, ""), (192, "x ONE two,three\\cmd four five six % seven\r\neight nine ten"), (192, "x"), (193, "one two three four five six seven eight nine")]
    df = spark.createDataFrame([(*r, 1, "h") for r in docs], "id bigint, text string, pos int, h string")
    got = leaked_items(df, "id", "text", spark.createDataFrame(items, "item bigint, text string"), "item", "text").collect()
    want = brute_leaks(docs, items)
    assert {tuple(r) for r in got} == want and len(got) == len(want) and (192, 92) in want and not any(d == 193 for d, _ in want)
    assert leaked_items(df.limit(0), "id", "text", spark.createDataFrame(items, "item bigint, text string"), "item", "text").collect() == []


PROSE = "The {0} of the {1} was measured in two ways. We found that {2} changes with {3}, although the {0} stays the same. Figure {4} shows the {5} after {4} hours. "
NOUNS = [f"{a}{b}" for a in ("mel", "tor", "van", "dris", "kol", "per", "sul") for b in ("ium", "or", "ane", "ith", "ous", "ep")]


def pages():
    random.seed(7)
    prose = lambda n: "".join(PROSE.format(*random.sample(NOUNS, 6)) for _ in range(n))
    tags = lambda n: "\n".join(f"SKU/{random.randint(1000, 9999)}: {random.choice(['cheap', 'best', 'buy'])} sofa, rated {random.randint(1, 50)}, sofa" for _ in range(n))
    links = lambda n: "\n".join(f"\\item \\href{{http://shop{random.randint(1, 999)}.example/{random.choice(NOUNS)}}}{{buy lamp}}" for _ in range(n))
    keywords = lambda n: " ".join(random.choice(["sofa", "cheap", "sale", "lamp", "buy", "best"]) for _ in range(n))
    table = "\n".join(f"{random.choice(NOUNS)}{random.choice(NOUNS)} & {random.random():.3f} & {random.randint(1, 5000)} \\\\" for _ in range(80))
    head = "\\documentclass{article}\n\\title{Cheap sofa sofa sofa}\n\\begin{document}\n"
    made = [(i, prose(12)) for i in range(120)]
    made += [(200, head + tags(60)), (201, links(60)), (202, "% " + keywords(400)), (203, prose(3) + keywords(900))]
    made += [(300, head + table), (301, prose(20) + keywords(60)), (302, None), (303, ""), (304, "  \n"), (305, head + "\\end{document}"), (306, head + "\\input{part}")]
    glossary = "\n".join(f"\\item[{random.choice(NOUNS)}{i}] {random.choice(NOUNS)} {random.choice(NOUNS)} of the {random.choice(NOUNS)}{random.choice(NOUNS)}" for i in range(70))
    references = "\n".join(f"\\bibitem{{k{i}}} {random.choice('ABCDEFGH')}. {random.choice(NOUNS).title()}, {random.choice(NOUNS).title()} and {random.choice(NOUNS)} in {random.choice(NOUNS)}s, {random.randint(1950, 2024)}." for i in range(70))
    files = "".join(f"\\input{{sections/{n}}}\n" for n in NOUNS[:40] * 2)
    statement = "Data statement. The data of the {} and the code that made the figures may be had from the authors on request.".format(NOUNS[0])
    made += [(310, head + files), (311, head + glossary), (312, head + references), (313, statement), (314, "\\includegraphics[width=3cm]{fig/sofa} " * 60), (315, "sofa sofa sofa")]
    return made


def test_stuffed_pages(spark):
    df = spark.createDataFrame([(i, t, random.choice(["en", "EN", None, "en-XX"]), 1, 2) for i, t in pages()], "doc_id bigint, text string, lang string, size int, id int")
    found = {r.id: r.stuffed_share for r in stuffed_share(df, "doc_id", "text", "lang").collect()}
    assert {i for i, s in found.items() if s > 0.5} == {200, 201, 202, 203}
    assert found[200] > 0.95 and not {302, 303, 304, 305, 306, 310, 314, 315} & set(found)
    assert not any(found.get(i, 0) > 0.2 for i in (300, 301, 311, 312, 313))
    assert stuffed_share(df.limit(0), "doc_id", "text", "lang").collect() == []


def test_labels_agree_with_the_found_pages(spark):
    d = "/root/testdata/sf0.1"
    votes = pd.read_parquet(f"{d}/doc_labels.parquet").groupby("doc_id").label.agg(lambda s: s.value_counts().index[0] if s.value_counts().iloc[0] * 2 > len(s) else "tie")
    found = {r.doc_id for r in p9_found(spark, d).collect()}
    said = votes[votes.isin(["stuffed", "article"])]
    right = {i for i, label in said.items() if label == "stuffed"}
    mine = found & set(said.index)
    assert len(mine & right) / len(right) > 0.9 and len(mine & right) / len(mine) > 0.85  # raters err


def test_blocks_cover_all_words():
    for _, t in pages():
        t = t or ""
        whole = re.findall(r"[^\W_]+", re.sub(r"\\[A-Za-z]+", " ", body(t)))
        assert sum(m["words"] for b in blocks(t) if (m := measure(b))) == len(whole)


def test_measures_have_no_rows_for_blank_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n ")], "i bigint, t string").selectExpr("i", "t", "'en' l")
    assert block_measures(df, "i", "t", "l").collect() == []
