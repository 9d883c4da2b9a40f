import itertools
import random

import pytest

from plumeline.llm import pieces as P


def toy():
    names = ["▁", "▁▁", "a", "b", "ab", "ba", "▁a", "▁ab", "aba", "bab", "c", "▁c", "é"]
    rng = random.Random(4)
    ids = {b: 100 + b for b in range(256)}
    return P.Vocabulary([(n, i, -rng.randrange(1, 40)) for i, n in enumerate(names)], ids)


def brute(v, text):
    """All segmentations of the marked text, whole, best scores first."""
    pieces = {p: (i, s) for p, e in v.known.items() if e for s, i in [e]}

    def go(at):
        if at == len(text):
            return [(0, ())]
        out = []
        steps = [(k, pieces[text[at:k]][1], (pieces[text[at:k]][0],)) for k in range(at + 1, len(text) + 1)
                 if text[at:k] in pieces]
        if text[at] not in pieces:
            raw = text[at].encode()
            steps.append((at + 1, len(raw) * v.byte_score, tuple(v.byte_ids[b] for b in raw)))
        for k, score, ids in steps:
            out += [(score + s, ids + rest) for s, rest in go(k)]
        return out

    return sorted(go(0), reverse=True)


@pytest.mark.parametrize("text", ["", "a", " ", "ab aba", "abab  ba", "a\nb", "zé a", "bababab", "c  c", "ababa ababa"])
def test_n_best_against_all_segmentations(text):
    v = toy()
    for n in (1, 2, 4):
        got = v.encode(text, n)
        every = brute(v, "▁" + text.replace(" ", "▁")) if text else [(0, ())]
        assert [s for s, _ in got] == [s for s, _ in every][:n]
        assert set(got) <= set(every) and len(set(got)) == len(got)
        assert all(v.decode(ids) == text for _, ids in got)


def test_model_round_trip():
    v = P.vocabulary(P.MODEL)
    for text in ("Hello  world\n\tx", "a▁b ▁▁", "naïve\x00z 日本語 🙂", "x" * 500, " lead", "tail \n"):
        for _, ids in v.encode(text):
            assert v.decode(ids) == text


def test_second_best_is_exact():
    v = P.vocabulary(P.MODEL)
    rng = random.Random(1)
    for _ in range(300):
        unit = "▁" + "".join(rng.choice("thereandoné") for _ in range(rng.randrange(0, 12)))
        paths = v.n_best(unit, 2)
        score, second, ids = v.viterbi(unit)
        assert score == paths[0][0] and second == (paths[1][0] if len(paths) > 1 else None)
        assert score == sum(e[0] for e in [v.known[unit[a:b]] for a, b in spans(v, ids)]) if "é" not in unit else True


def spans(v, ids):
    at = 0
    for i in ids:
        n = len(v.raw[i].decode())
        yield at, at + n
        at += n


def test_query_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "the cat  sat", "c"), (3, "the cat  sat", "c"), (4, "long " * 5000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_best string")
    got = P.segment(df, {"doc_id": df.doc_id}, with_ids=True).collect()
    assert len(got) == 5 and all(r.round_trip for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].n_pieces == by[2].n_pieces == 0 and by[1].scores == "0"
    v = P.vocabulary(P.MODEL)
    assert v.decode(by[3].ids) == "the cat  sat" and by[4].n_pieces == len(by[4].ids)
    assert P.segment(df.limit(0), {"doc_id": df.doc_id}).count() == 0
    assert list(itertools.islice(by[3].scores.split(","), 2)) == [str(s) for s, _ in v.encode("the cat  sat", 2)]


def test_many_units_at_once_equal_single_ones():
    names = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "xyz", "y", "z"]  # x begins a piece but is none
    rng = random.Random(8)
    v = P.Vocabulary([(n, i, -rng.randrange(1, 9)) for i, n in enumerate(names)], {b: 100 + b for b in range(256)})
    units = sorted({"▁" * rng.randrange(0, 3) + "".join(rng.choice("aabbxyzé") for _ in range(rng.randrange(1, 14)))
                    for _ in range(400)})
    together = v.viterbi_all(units)
    assert any(together) and not all(together)
    for unit, found in zip(units, together):
        score, second, ids = v.viterbi(unit)
        every = brute(v, unit) if len(unit) < 9 else []
        if every:
            assert [score, second] == ([s for s, _ in every] + [None])[:2]
        if found is None:
            assert set(unit) & set("xé")
            continue
        assert found[:4] == (score, None if second is None else score - second, len(ids), ",".join(map(str, ids)))
        assert found[4] == unit.replace("▁", " ")


def whole_text_best(pieces, longest, byte_ids, byte_score, text, n):
    """The n best of the marked text as one lattice, without units: (score, ids) lists per position."""
    at = [[(0, None)]] + [[] for _ in text]
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            found = pieces.get(text[start:end])
            if found:
                own = (found[0],)
                more = found[1]
            elif end == start + 1:
                own = tuple(byte_ids[b] for b in text[start].encode())
                more = len(own) * byte_score
            else:
                continue
            at[end] += [(s + more, (own, chain)) for s, chain in at[start]]
        at[end] = sorted(at[end], key=lambda e: -e[0])[:n]
    out = []
    for score, chain in at[-1]:
        ids = []
        while chain:
            ids[:0] = chain[0]
            chain = chain[1]
        out.append((score, ids))
    return out


def test_segment_against_one_lattice_per_text(spark, sf):
    import hashlib

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    plain = [i for i in range(model.vocab_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): (i, int(model.get_score(i))) for i in plain}
    byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.vocab_size()) if model.is_byte(i)}
    worst = min(s for _, s in pieces.values() if s > -(10 ** 8)) - 10
    df = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) between 1 and 1500").limit(60)
    texts = {r.doc_id: r.text for r in df.collect()}
    got = P.segment(df, {"doc_id": df.doc_id}).collect()
    assert len(got) == len(texts) > 20
    for r in got:
        paths = whole_text_best(pieces, max(map(len, pieces)), byte_ids, worst,
                                "▁" + texts[r.doc_id].replace(" ", "▁"), P.N_BEST)
        assert r.scores == ",".join(str(s) for s, _ in paths) and r.round_trip and r.n_best == len(paths)
        if len(paths) < 2 or paths[0][0] > paths[1][0]:
            ids = paths[0][1]
            assert (r.n_pieces, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
