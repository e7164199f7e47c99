"""Filter audit and packing against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from subscore.llm import filter_audit, packing, queries

LABELS = "doc_id long, quality int, toxic int"
WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- 11 --------------------------------------------------------------------


def _failed(rows):
    """The letters that each row fails."""
    out = []
    for doc, text, *_ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, *_ in rows),
        }
        out.append({k for k, v in fails.items() if v})
    return out


def _audit(rows, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    failed = _failed(rows)
    out, over_orders = [], Counter()
    for part in {r[3] or "" for r in rows}:
        own = [k for k, r in enumerate(rows) if (r[3] or "") == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in failed[k]]
                left = [k for k in left if f not in failed[k]]
                over_orders[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(f in failed[k] for k in own) - len(gone),
                            sum(failed[k] == {f} for k in own), sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)))
    return [(*r, over_orders[r[0], r[1][r[2] - 1]]) for r in out]


def _rows(case_rows):
    rng = random.Random(8)
    loud = "LOUD " * 230 + "# end"
    extra = [(9000 + k, t, "en", s, 0) for k, (t, s) in enumerate([(loud, "hot"), (loud, None), (loud, "hot"), ("100% & more", "")])]
    extra += [(9001, loud, "en", "hot", 0), (None, loud, "en", "hot", 0), (9007, "\x0b ".join(f"w{rng.random()}" for _ in range(300)), "en", "hot", 0)]
    return case_rows + extra


def test_audit_equals_running_every_order(spark, case_rows, tmp_path):
    rows = _rows(case_rows)
    rng = random.Random(3)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1])) for r in rows if rng.random() < 0.6] + [(9001, 1, 0), (None, 1, 1), (10**9, 1, 1)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, columns).selectExpr("*", "doc_id _id", "'x' part", "1 _mask", "2 n", "'g' _good")
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "'z' _label_id", "0 source")
    got = filter_audit.audit_filters(docs.repartition(4), marks)
    assert sorted(map(tuple, got.collect())) == sorted(_audit(rows, labels))


def test_audit_of_nothing(spark, empty, documents):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(empty, none).count() == 0
    assert filter_audit.audit_filters(documents, none).filter("good_lost + toxic_lost > 0").count() == 0


def test_audit_of_other_filters(spark, documents):
    conditions = {"X": filter_audit.F.col("_words") < 3, "Y": filter_audit.F.col("_points") > 500}
    got = filter_audit.audit_filters(documents, spark.createDataFrame([], LABELS), conditions)
    assert {r.filter_order for r in got.select("filter_order").collect()} == {"".join(p) for p in permutations("XYE")}


@pytest.mark.parametrize("f", [1, 2, 3, 5])
def test_least_squares_give_the_shapley_value(f):
    rng = random.Random(f)
    v = [Fraction(0), *(Fraction(rng.randrange(100)) for _ in range(2**f - 1))]
    got = [sum(w * x for w, x in zip(row, v)) for row in filter_audit.shapley_weights(f)]
    plain = [Fraction(0)] * f
    for order in permutations(range(f)):
        s = 0
        for k in order:
            plain[k] += v[s | 1 << k] - v[s]
            s |= 1 << k
    assert got == [x / factorial(f) for x in plain]


# --- 12 --------------------------------------------------------------------


def _texts():
    """Special strings, contractions, signs, composed and decomposed letters, long words, all of the first 256 characters."""
    odd = ["<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "It's we'll I'M don't 's", "x²¼ 3½ ªº µ", "é é É ÀÖØÞß", "İ ﬁ ½１２ 漢字かな 🙂",
           "a\x1cb c\x85d\xa0e f", "".join(map(chr, range(1, 256))), "_a_ $1,234.50 --- #x\x00y", "﻿bom ​z", "q" * 5000]
    return odd + [" ".join(odd), *(o + " " + o for o in odd)]


def _pieces(rows):
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        n = len(r.ids) // 4
        of_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        of_sequence[r.sequence_id].append((r.offset, n))
    return of_doc, of_sequence


@pytest.mark.parametrize("window, most", [(4096, 1024), (64, 1024), (256, 8)])
def test_every_id_is_in_one_piece(spark, case_rows, window, most):
    texts = _texts() + [r[1] for r in case_rows]
    docs = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, sequence_id int").repartition(3)
    of_doc, of_sequence = _pieces(packing.pack_documents(docs, WORDS, window, most=most).collect())
    tokenizer = Tokenizer.from_file(WORDS)
    for k, text in enumerate(texts):
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        got = []
        for start, ids, tokens in sorted(of_doc.pop(k)):
            assert start == len(got) and tokens == len(expected) and ids
            got += ids
        assert got == expected
    assert not of_doc
    for pieces in of_sequence.values():
        total = 0
        for offset, n in sorted(pieces):
            assert offset == total
            total += n
        assert total <= window and total & (total - 1) == 0  # nothing to pad


def test_packing_query_and_nulls(spark, documents, empty, case_rows):
    assert packing.pack_documents(empty, WORDS).count() == 0
    got = packing.pack_documents(documents, WORDS).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(r[0] for r in case_rows)
    folder = documents.inputFiles()[0].rsplit("/documents.parquet", 1)[0]
    for r in queries.op12_packing(spark, folder).collect():
        assert r.length > 0
    crcs = Counter((r.doc_id, r.start, zlib.crc32(r.ids)) for r in got)
    assert crcs == Counter((r.doc_id, r.start, r.ids_crc32) for r in queries.op12_packing(spark, folder).collect())


def test_an_item_goes_where_the_sum_of_squares_grows_least():
    rng = random.Random(6)
    window, levels, full = 32, packing.Levels(32), 0
    for _ in range(3000):
        r = rng.randrange(1, window)
        squares = {}
        for h in range(window - r + 1):
            if h and not levels.count[h]:
                continue
            count = levels.count.copy()
            count[h] -= h > 0
            count[h + r] += 1
            squares[h] = int((count[1:window] ** 2).sum())
        h = levels.best(r)
        assert squares[h] == min(squares.values()) and h == max(k for k in squares if squares[k] == squares[h])
        if h:
            levels.take(h)
        if h + r < window:
            levels.put(h + r, None)
        else:
            full += 1
    assert levels.open == levels.count.sum() and full > 5 * levels.open
