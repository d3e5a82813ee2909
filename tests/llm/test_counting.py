"""Quality rules, token counts, packing and language-model scores against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF001, clashing, make_docs, odd_docs, prose  # noqa: F401
from quire.llm import lm_score, packing, quality, queries, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# quality rules --------------------------------------------------------------
def measures(text):
    words = WORD.findall(text or "")
    spots = collections.defaultdict(list)
    for i in range(len(words) - 2):
        spots[tuple(words[i: i + 3])].append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def failed(m):
    return m[0] < 50 or 100 * m[4] > 50 * m[0]


def test_measures_match_brute_force(spark, odd_docs, make_docs, prose):
    docs = odd_docs.union(make_docs([(100 + i, prose(i, 40 + 30 * i) + "\n# a $ | b\n\n" + prose(i, 20)) for i in range(6)]))
    rows = quality.measure(docs.select("doc_id", "text"), ["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r)[2:] == measures(r["text"]), (r["doc_id"], (r["text"] or "")[:40])


def test_host_verdicts_shrink_small_hosts(spark, make_docs, prose, monkeypatch):
    good, bad = prose(1, 80), "too short"
    rows = [(i, good, "big") for i in range(60)] + [(100 + i, bad, "farm") for i in range(40)]
    rows += [(200, bad, "tiny"), (201, good, "farm"), (202, good, None), (203, bad, None)]
    out = {r["doc_id"]: r for r in quality.judge(make_docs(rows)).collect()}
    assert len(out) == len(rows)
    assert all(out[i]["kept"] for i in range(60))
    assert not out[201]["kept"] and not out[201]["base_failed"]  # the host's verdict
    assert out[202]["kept"] and not out[203]["kept"]
    n, k = {"big": 60, "farm": 41, "tiny": 1, None: 2}, {"big": 0, "farm": 40, "tiny": 1, None: 1}
    total, p = 104, 42 / 104
    spare = total - sum(v * v for v in n.values()) / total
    between = (sum(k[h] ** 2 / n[h] for h in n) - total * p * p - 3 * p * (1 - p)) / spare
    s = min(1000, max(5, p * (1 - p) / between - 1))
    assert out[200]["host_rate"] == pytest.approx((1 + s * p) / (1 + s), abs=1e-6)
    assert out[200]["host_rate"] < 1  # not judged by its one document alone
    for sent in (quality.MAX_SENT_HOSTS, 0):
        monkeypatch.setattr(quality, "MAX_SENT_HOSTS", sent)
        kept = quality.keep_good(make_docs(rows))
        assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(i for i, r in out.items() if r["kept"])


def test_quality_odd_rows(spark, odd_docs, clashing, make_docs, prose):
    docs = clashing(odd_docs.union(make_docs([(50, prose(3, 90), "t"), (50, prose(3, 90), "t"), (None, prose(4, 70), "t")])))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 50), (False, 50), (True, None)]
    assert quality.judge(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


# token counts -----------------------------------------------------------------
def vocabulary():
    return token_counts.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def greedy(word, start, inner):
    at, n = 0, 0
    while at < len(word):
        pieces = inner if at else start
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_is_greedy_longest_match(spark):
    start, inner = (set(x) for x in (["a", "abcd", "b", "ab", "q"], ["b", "c", "bc", "bcx", "cd", "d", "a"]))
    automaton = token_counts.build_automaton(start, inner)
    import itertools
    for n in range(1, 8):
        for w in map("".join, itertools.product("abcdx", repeat=n)):
            assert token_counts.word_pieces(w, automaton) == greedy(w, start, inner), w
    assert token_counts.word_pieces("q" + "bc" * 5000, automaton) == greedy("q" + "bc" * 5000, start, inner)


def test_token_counts_match_greedy_over_the_table(spark):
    start, inner = map(set, vocabulary())
    memo = {}

    def count(w):
        if w not in memo:
            memo[w] = greedy(w, start, inner)
        return memo[w]

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.op8_token_counts(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = [count(w) for w in WORD.findall(texts[r["doc_id"]] or "")]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(n), sum(max(x, 1) for x in n), n.count(-1))


def test_word_pieces_match_a_public_implementation():
    from tokenizers import models
    start, inner = vocabulary()
    vocab = {w: i for i, w in enumerate([*dict.fromkeys(["[UNK]", *start, *("##" + x for x in inner)])])}
    model = models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=1000)
    automaton = token_counts.build_automaton(start, inner)
    for word in "the unbelievable Straßenbahnen xylophones 12345 don't naïveté qzjxkw ouédraogo".split():
        found = [t.value for t in model.tokenize(word)]
        assert token_counts.word_pieces(word, automaton) == (-1 if found == ["[UNK]"] else len(found))


def test_token_counts_odd_rows(spark, odd_docs, clashing):
    out = token_counts.token_counts(clashing(odd_docs), vocabulary()).collect()
    assert len(out) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in out}
    assert tuple(by_id[0])[1:] == (0, 0, 0) == tuple(by_id[1])[1:] == tuple(by_id[2])[1:]
    assert by_id[7]["n_words"] == 50_000 and by_id[8]["n_words"] == 1
    assert token_counts.token_counts(odd_docs.limit(0), vocabulary()).count() == 0


# packing ------------------------------------------------------------------------
def check_packing(rows, texts, capacity=2048):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            own = np.array(ids[at: at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(own), doc_id
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & at - 1 == 0 else capacity - at
    return padding, total


def test_packing_over_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.op4_packing(spark, SF001).collect()
    padding, total = check_packing(rows, texts)
    assert padding < 0.01 * total
    pieces = collections.Counter(r["doc_id"] for r in rows)
    fitting = {r["doc_id"] for r in rows if r["doc_tokens"] <= 2048}
    assert sum(pieces[i] == 1 for i in fitting) > 0.8 * len(fitting)


def ids_of(n):
    return np.arange(n, dtype="<u4").tobytes()


def test_packing_classes_take_fixed_counts():
    bins = packing.Bins(1024, 0)
    done = [d for i in range(9) for d in bins.add(i, ids_of(256 - i % 2))]  # classes 4 and 4
    assert [len(d) for d in done] == [4, 4] and [p[-1] for p in done[0]] == [0, 256, 511, 767]
    assert all(p[1] == 0 and p[2] == p[4] for d in done for p in d)  # whole documents
    assert [packing.harmonic_class(n, 2048) for n in (1, 32, 682, 683, 1024, 1025, 2048)] == [64, 64, 3, 2, 2, 1, 1]


def test_packing_fills_gaps_by_long_documents():
    bins = packing.Bins(1024, 0)
    assert not list(bins.add(1, ids_of(900)))  # full, but for a gap of 124
    done = [d for d in bins.add(2, ids_of(1500))]
    assert [[(p[0], p[1], p[2]) for p in d] for d in done] == [[(1, 0, 900), (2, 0, 124)]]
    rest = list(bins.close())
    assert [sum(p[2] for p in d) for d in rest] == [1024, 256, 64, 32]
    assert [p[1] for d in rest for p in d] == [124, 1148, 1404, 1468]


def test_packing_cuts_fitting_documents_only_for_want_of_others():
    bins = packing.Bins(1024, 0)
    done = [d for i in range(400) for d in bins.add(i, ids_of(700))] + list(bins.close())
    sizes = [sum(p[2] for p in d) for d in done]
    assert sum(sizes) == 400 * 700 and all(s > 1024 - packing.LEAST_PIECE or s & s - 1 == 0 for s in sizes)
    pieces = collections.Counter(p[0] for d in done for p in d)
    assert sum(n > 1 for n in pieces.values()) < 140  # 124,600 ids of gaps need 178 documents at most


def test_byte_letters():
    assert packing.byte_letters()[0x41] == "A" and sorted(packing.byte_letters()) == list(range(256))


@pytest.fixture()
def fresh_words():
    from tokenizers import Tokenizer
    return packing.WordIds(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_packing_sends_only_odd_words_through_the_whole_tokenizer(fresh_words):
    tokenizer, sent, encode = fresh_words.tokenizer, [], fresh_words.encode
    fresh_words.encode = lambda texts: sent.extend(texts) or encode(texts)
    texts = ["Übung macht&&& den Meister&&&, ÉTÉ!! été. a", "", None, " Don't  K9 ªµº macht&&&\n"]
    for text, ids in zip(texts, packing.document_ids([t and t.encode() for t in texts], fresh_words)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    assert sorted(sent) == ["", "!!", "&&&", "&&&,", ".", "don't", "k9"]


def test_packing_letters_and_marks_like_the_tokenizer(fresh_words):
    letters = [chr(c) for c in range(33, 0x2200)]
    texts = [form.format(c) for c in letters for form in ("{}", "a{}.", "É{}b&", "x.{}'")]
    expected = fresh_words.encode(texts)
    assert list(packing.document_ids([t.encode() for t in texts], fresh_words)) == expected


def test_packing_words_stay_known_between_tasks(monkeypatch, fresh_words):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.words_of(path, 1.0) is packing.words_of(path, 1.0)
    assert packing.words_of(path, 1.0) is not packing.words_of(path, 2.0)  # another file by then
    monkeypatch.setattr(packing, "MEMO_WORDS", 3)
    list(packing.document_ids([b"one two three"], fresh_words))
    list(packing.document_ids([b"two four five"], fresh_words))
    assert set(fresh_words.known) == {b"two", b"four", b"five"}


def test_packing_odd_texts(spark, odd_docs, make_docs, clashing):
    odd = {20: "<|startoftext|> Don't STOP. <|ENDOFTEXT|>, ok", 21: "ÀÉÎ Ünïcode, İstanbul ſtraße ΑΣ K", 22: "été. ǆ ﬁn",
           23: "word.. a.b, c,. 'S 'll", 24: "İ. ı, ß."}
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).union(make_docs(list(odd.items())))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding, _ = check_packing(packing.pack(clashing(docs), public_tokenizers.path("word_bpe_49k.json")).collect(), texts)
    assert padding < 200
    assert packing.pack(odd_docs, public_tokenizers.path("word_bpe_49k.json")).where("doc_id is null").agg(
        F.sum("length")).first()[0] > 2
    assert packing.pack(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=1000)


# language-model scores -------------------------------------------------------------
def lm_brute(docs):
    """doc_id -> n_words, n_seen, score."""
    log = lambda c: round(math.log(max(c, 1)) * 1_000_000)
    fold = {i: 0 if i is None else int(hashlib.md5(str(i).encode()).hexdigest()[0], 16) % 2 for i, _ in docs}
    one, two = (collections.Counter(), collections.Counter()), (collections.Counter(), collections.Counter())
    seqs = [(i, ["<s>", *re.findall(r"[^\W_]+", (t or "").lower())]) for i, t in docs]
    for i, s in seqs:
        one[fold[i]].update(s)
        two[fold[i]].update(zip(s, s[1:]))
    out = {}
    for i, s in seqs:
        a, b = one[1 - fold[i]], two[1 - fold[i]]
        total = sum(a.values()) - a["<s>"]
        n, seen, score = out.get(i, (0, 0, 0))
        for v, w in zip(s, s[1:]):
            n += 1
            if b[v, w]:
                seen += 1
                score += log(b[v, w]) - log(a[v])
            else:
                score += round(math.log(0.4) * 1_000_000) + log(a[w]) - log(total)
        out[i] = n, seen, score
    return out


@pytest.mark.parametrize("known_bits,hot_bits", [(20, 10), (5, 2), (0, 0)])
def test_lm_scores_match_brute_force(spark, make_docs, odd_docs, prose, known_bits, hot_bits):
    docs = make_docs([(i, prose(i % 17, 120)) for i in range(40)]).union(odd_docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_seen"], r["score_micro"]) for r in lm_score.lm_scores(
        docs, known_bits=known_bits, hot_bits=hot_bits).collect()}
    assert got == lm_brute(rows)


def test_lm_words_are_split_once_to_be_counted(make_docs, odd_docs, prose, capfd):
    docs = make_docs([(i, prose(i, 30)) for i in range(9)])
    lm_score.word_rows(docs, "doc_id", "text").groupBy("fold", "h").count().explain()
    plan = capfd.readouterr().out
    assert plan.count("split(lower(") == 1 and plan.count("md5(") == 1
    assert plan.index("Generate") < plan.index("md5(")  # once a document
    docs = docs.union(odd_docs)
    rows = lm_score.word_rows(docs, "doc_id", "text")
    listed = lm_score._hashed(docs, "doc_id", "text").select("fold", F.explode("h").alias("h"))
    assert rows.exceptAll(listed).count() == listed.exceptAll(rows).count() == 0 < rows.count()


def test_lm_scores_prefer_familiar_text(spark, make_docs, prose, clashing):
    docs = clashing(make_docs([(i, prose(i % 5, 100)) for i in range(30)] + [(99, "zyx wvu tsr qpo nml " * 20), (100, "")]))
    out = {r["doc_id"]: r["mean_logprob"] for r in lm_score.lm_scores(docs).collect()}
    assert out[99] < min(out[i] for i in range(30)) and out[100] is None
    assert lm_score.lm_scores(docs.limit(0)).count() == 0


def trigram_brute(docs):
    """doc_id -> score at order three."""
    log = lambda c: round(math.log(max(c, 1)) * 1_000_000)
    fold = {i: 0 if i is None else int(hashlib.md5(str(i).encode()).hexdigest()[0], 16) % 2 for i, _ in docs}
    seqs = [(i, ["<s>", *re.findall(r"[^\W_]+", (t or "").lower())]) for i, t in docs]
    grams = [collections.Counter(), collections.Counter()]
    for i, s in seqs:
        for n in (1, 2, 3):
            grams[fold[i]].update(tuple(s[k: k + n]) for k in range(len(s) - n + 1))
    out = collections.Counter({i: 0 for i in fold})
    for i, s in seqs:
        c = grams[1 - fold[i]]
        total = sum(n for g, n in c.items() if len(g) == 1) - c["<s>",]
        for k in range(1, len(s)):
            for n in range(min(3, k + 1), 0, -1):
                gram = tuple(s[k - n + 1: k + 1])
                if n == 1:
                    out[i] += log(c[gram]) - log(total)
                elif c[gram]:
                    out[i] += log(c[gram]) - log(c[gram[:-1]])
                    break
                else:
                    out[i] += round(math.log(0.4) * 1_000_000)
    return dict(out)


def test_lm_scores_of_order_three(spark, make_docs, odd_docs, prose):
    mixed = {i: prose(i % 17, 120) for i in range(40)} | {50: " ".join(sorted(prose(3, 120).split())), 51: "one", 52: "ka lo"}
    docs = make_docs(list(mixed.items())).union(odd_docs.where("doc_id is null or doc_id < 6"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["score_micro"] for r in lm_score.lm_scores(docs, order=3).collect()}
    assert got == trigram_brute(rows)
    assert got != {r["doc_id"]: r["score_micro"] for r in lm_score.lm_scores(docs).collect()}
    with pytest.raises(ValueError):
        lm_score.lm_scores(docs, order=4)
