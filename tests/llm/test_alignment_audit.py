"""Cross-tokenizer alignment and the source audit, against brute force."""

import hashlib
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from gaugework.llm import runs as R
from gaugework.llm import source_audit as S
from gaugework.llm import token_alignment as T
from gaugework.llm.queries import VOCABULARIES

A_FILE, B_FILE = (Path(VOCABULARIES, n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def test_packed_counts_come_back():
    rng = np.random.default_rng(1)
    cells = [np.unique(rng.integers(0, 1 << 20, n)) for n in (0, 1, 500)]
    import pyarrow as pa

    row, at, n = R.unpack(pa.array([R.pack(c, c % 70_000 + 1) for c in cells], pa.binary()))
    assert row.tolist() == [1] * len(cells[1]) + [2] * len(cells[2])
    assert at.tolist() == np.concatenate(cells).tolist() and n.tolist() == (np.concatenate(cells) % 70_000 + 1).tolist()


def test_intervals_with_gaps_are_coalesced():
    a, b = np.array([[0, 3], [3, 5], [9, 10], [20, 30]]), np.array([[0, 4], [4, 5], [5, 6], [12, 13], [21, 22], [22, 40]])
    ga, gb, n = T.coalesced(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert (ga.tolist(), gb.tolist(), n) == ([0, 0, 2, 4], [0, 0, 1, 3, 4, 4], 5)
    x, y = T.overlaps(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert sorted(zip(x.tolist(), y.tolist())) == sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if max(p[0], q[0]) < min(p[1], q[1]))


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    t, sp = Tokenizer.from_file(str(A_FILE)), sentencepiece.SentencePieceProcessor(model_file=str(B_FILE))
    t.encode_special_tokens = True
    letters = T.byte_letters()
    entries = {i: bytes(letters[c] for c in e) for e, i in t.get_vocab().items() if not e.startswith("<|")}
    found, pairs = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, entries[i]) for i in t.encode(whole.decode(), add_special_tokens=False).ids] if text else []
        pieces = [(i, sp.id_to_piece(i)) for i in sp.encode(text or "")]
        b = [(i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        places = []
        for side in (a, b):
            at = 0
            places.append([(i, at, at := at + len(x)) for i, x in side])
        cuts = sorted({e for *_, e in places[0]} & {e for *_, e in places[1]})
        cells = [defaultdict(list), defaultdict(list)]
        for side, cell in zip(places, cells):
            for i, s, _ in side:
                cell[bisect_right(cuts, s)].append(str(i))
        groups = ["|".join(",".join(cell[g]) for cell in cells) for g in range(len(cuts))]
        links, j = [], 0
        for i, s, e in places[0]:
            while places[1][j][2] <= s:
                j += 1
            k = j
            while k < len(places[1]) and places[1][k][1] < e:
                links.append((i, places[1][k][0]))
                k += 1
        pairs.update(links)
        found.append((doc_id, a, b, groups, links))
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return sorted(
        (d is None, d or 0, len(a), len(b), len(g), len(x), sum(pairs[p] == best[p[1]] for p in x), sum(pairs[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for d, a, b, g, x in found
    )


def aligned(docs, **given):
    rows = T.align(docs, A_FILE.read_bytes(), B_FILE.read_bytes(), **given).collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in (*T.FIGURES, "n_best", "count_sum", "groups_sha256")]) for r in rows)


def test_alignment_of_odd_texts(make):
    texts = [
        None, "", " ", "a", "<|endoftext|> and <s> </s> <0x41>", "A▁B", "tab\there\n\n and  two  blanks ", "日本語 naïve 😀 é", "a b c", "x" * 5000,
        "plain words here and there", "plain words here and there", " leading blank", "don't I'll 12345 !!!",
    ]
    rows = [(i // 2 if i % 5 else None, t) for i, t in enumerate(texts)]
    docs = make([(i, t, "en", "a") for i, t in rows])
    expected = brute_alignment(rows)
    assert aligned(docs) == expected == aligned(docs, run_bytes=16)
    assert sum(r[2] > 0 for r in expected) >= 9


def test_alignment_of_the_tables(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert aligned(docs, run_bytes=1 << 16) == brute_alignment([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert aligned(none) == []
    assert aligned(odd) == brute_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_long_white_space_takes_the_other_encoder():
    e = T.Encoders(A_FILE.read_bytes(), B_FILE.read_bytes())
    text = "a" + " " * (T.WHITE_RUN + 5) + "b" + "\t" * 1000
    assert T.long_white(text) and not T.long_white("ab " * T.WHITE_RUN)
    assert b"".join(e.a_bytes[i] for i in e.encode([text])[0][0]) in (b"", b" " + text.encode())
    assert e._whole(" a  b\n\nc <|endoftext|>") == e._a.encode_ordinary(" a  b\n\nc <|endoftext|>")
    with pytest.raises(ValueError):
        T.byte_level_entries(b'{"model": {"vocab": {"ab": 256, "cd": 257}, "merges": ["c d", "a b"]}}')


def brute_audit(rows, least, top):
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    fold = str.maketrans(S.UPPER, S.LOWER)
    terms = [re.findall(S.TERM, t.translate(fold)) for t, _, _ in rows]
    documents, counts, of_lang = defaultdict(int), defaultdict(int), defaultdict(int)
    for (_, lang, s), found in zip(rows, terms):
        for t in set(found):
            documents[lang, t] += 1
        for t in found:
            counts[lang, s, t] += 1
            of_lang[lang, t] += 1
    kept = {lang: [t for (x, t), n in documents.items() if x == lang and n >= least] for _, lang, _ in rows}
    groups = {(lang, s) for _, lang, s in rows}
    weight = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    p = {(lang, s): {t: weight(counts[lang, s, t], sum(counts[lang, s, u] for u in kept[lang]), len(kept[lang])) for t in kept[lang]} for lang, s in groups}
    q = {lang: {t: weight(of_lang[lang, t], sum(of_lang[lang, u] for u in v), len(v)) for t in v} for lang, v in kept.items()}
    out = []
    for lang, s in groups:
        mine = p[lang, s]
        pairs = [(sum(apart(mine[t], p[lang, o][t]) for t in kept[lang]), o) for x, o in groups if x == lang and o != s]
        own = [(apart(mine[t], q[lang][t]), t) for t in kept[lang] if counts[lang, s, t] and mine[t] > q[lang][t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", own, top)):
            out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most])]
    return sorted(out)


def audited(docs, **given):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in S.audit(docs, **given).collect())


def test_audit_of_odd_rows(make, odd, none):
    assert audited(none) == []
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert audited(odd, least_documents=2) == brute_audit(rows, 2, 10)
    rows = [(f"Ünder-{'x' * (i % 3)}the THE the,sea 1{'ß' * (i % 4)}1 a{i % 7}b", ("en", "de", None)[i % 3], ("a", "b", "ç", None, "")[i % 5]) for i in range(120)] + [("", "fr", "lonely")]
    docs = make([(i % 50, *r) for i, r in enumerate(rows)])
    expected = brute_audit(rows, 10, 3)
    assert audited(docs, top=3) == expected == audited(docs, top=3, run_bytes=64) and {r[2] for r in expected} == {"pair", "term"}


def test_weights_at_great_counts(spark):
    for n, total, v in ((10**12, 4 * 10**14, 10**7), (0, 10**15, 10**9), (10**15, 10**15, 1)):
        got = spark.sql(f"select {S.weight(f'{n}L', f'{total}L', f'{v}L')} as p").first()["p"]
        assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)
