"""Quality classifier, secrets, media and packing against plain Python."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import defaultdict

import pytest

from presswork.llm import media, packing, quality, secrets
from presswork.llm.queries import op2_quality_classifier, op5_media_chunks, op6_secret_scan, op8_best_fit_packing


def docs_of(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


# quality

MASK = (1 << 64) - 1


def mixed(x):
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * times & MASK
    return x ^ x >> 31


def polynomial(codes):
    return sum((c + 1) * pow(0x9E3779B97F4A7C15 | 5, k, 1 << 64) for k, c in enumerate(codes)) & MASK


def buckets_by_hand(text):
    """Buckets of all features of a text, one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    keys = [mixed(polynomial(w.encode())) for w in words]
    out = list(keys)
    for n in quality.WORDS:
        for k in range(len(words) - n + 1):
            gram = same = n
            for j in range(n):
                gram = mixed((gram + keys[k + j]) & MASK)
                for i in range(j):
                    same = same << 1 | (words[k + i] == words[k + j])
            out += [gram, mixed(same)]
    for w in words:
        code = [quality.MARK, *map(ord, w), quality.MARK]
        for n in quality.CHARACTERS:
            out += [mixed((polynomial(code[k : k + n]) + n) & MASK) for k in range(len(code) - n + 1)]
    return [x >> 64 - quality.BITS for x in out]


def test_quality_scores_against_plain_python(spark, sf, documents):
    model = quality.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    odd = [None, "", " \t", "a", "é", "a a", "日本 語 \n x", "\x85 \xa0b \x1c"]
    texts = [d.text for d in documents] + odd
    got = {r.doc_id: r.score for r in quality.scored(docs_of(spark, list(enumerate(texts))), model).collect()}
    w = model.weights
    for i, t in enumerate(texts):
        idx = buckets_by_hand(t)
        z = sum(float(w[x]) for x in idx) / max(len(idx), 1) + model.offset
        assert abs(got[i] - 1 / (1 + math.exp(-max(min(z, 500), -500)))) < 1e-9, t


def test_quality_on_held_out_rows(spark, sf):
    sf = sf.replace("0.001", "0.1")
    got = op2_quality_classifier(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = defaultdict(list)
    for r in got:
        if r.held_out and r.doc_id in labels:
            for k in ("all", docs[r.doc_id], f"label {labels[r.doc_id]}"):
                held[k].append(r.predicted == labels[r.doc_id])
    print("held-out accuracy", {k: (sum(v) / len(v), len(v)) for k, v in held.items()})
    assert sum(held["all"]) > 0.99 * len(held["all"]) and sum(held["label 1"]) > 0.97 * len(held["label 1"])
    assert all(sum(v) > 0.97 * len(v) for v in held.values())


def test_quality_learns_from_a_bounded_sample(spark):
    rows = [(i, ("calm words " if i % 2 else "BUY!! ") * (10 + i)) for i in range(1, 40)] + [(40, "long " * 5000)]
    df, labels = docs_of(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    small = quality.learn(df, labels, size=3000)
    ids = {r.doc_id: r.score for r in quality.scored(df, small).collect()}
    assert len(ids) == 40 and ids[1] > 0.5 > ids[2]


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = [(i, "calm words in plain prose " * 3 if i % 2 else "BUY!! NOW!! $$$ ###") for i in range(1, 60)] + [(100, None), (101, ""), (None, "plain prose"), (102, "x" * 200_000), (1, "calm words in plain prose " * 3)]
    df = docs_of(spark, [(*r, "s", 1.5) for r in rows], "doc_id long, text string, label string, score double")
    got = quality.classify(spark, df, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[100].score == by[101].score and not by[None].held_out
    assert by[1].predicted == 1 and by[2].predicted == 0
    none = quality.classify(spark, df.limit(0), labels)
    assert none.collect() == [] and none.columns == ["doc_id", "held_out", "score", "predicted"]
    assert {r.score for r in quality.classify(spark, df, labels.limit(0)).collect()} == {0.5}


def test_quality_is_the_same_again(spark, sf):
    assert sorted(op2_quality_classifier(spark, sf).collect()) == sorted(op2_quality_classifier(spark, sf).collect())


# secrets


def base_spans(text):
    out = []
    text = text or ""
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def expected_base(text):
    spans = base_spans(text)
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(listed.encode()).hexdigest())


def test_secrets_over_the_whole_table(spark, sf, documents):
    got = {r.doc_id: r for r in op6_secret_scan(spark, sf).collect()}
    assert len(got) == len(documents)
    for d in documents:
        r = got[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == expected_base(d.text)


def test_secret_edge_cases(spark):
    texts = [None, "", "é token='abcdefghijkl' x", "TOKEN = short", "apikey:ABCDEFGHIJKL api_key=\"0123456789abcdef\"", "toKen=abcdefghijkl", "AKIA" + "A" * 13, "AKIA" + "Z" * 14, "0123456789abcdef" * 3, "password: Xq7!vR2#kLp9 now", "password: password123", "pwd=aaaaaaaaaaaa", "secret is unknown", "ftp://bob:T7x!9qLmW2zz@host/", "token = short token = abcdefghijklmnop", "x" * 200_000]
    got = {r.doc_id: r for r in secrets.find_secrets(spark, docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == expected_base(t), t
    assert "guess" in got[9].spans and "guess" in got[13].spans
    assert "guess" not in (got[10].spans + got[11].spans + got[12].spans)
    assert secrets.redact(texts[9]).count("[SECRET]") == 1 and "Xq7" not in secrets.redact(texts[9])
    assert secrets.find_secrets(spark, docs_of(spark, [])).collect() == []


def test_secrets_have_their_whole_length():
    rng = random.Random(5)
    for n in (199, 201, 1000, 200_000):
        value = "".join(rng.choices("abcdefghijkmnopqrstuvwxyzABCDEFGHIJKLMNPQRSTUVWXYZ23456789@,;#", k=n)) + "Z"
        for head in ("auth=", "pwd: ", "private_key='"):
            assert secrets.redact(f"a {head}{value} b") == f"a {head}[SECRET] b", (head, n)
        pw = re.sub("[@,;]", "x", value)
        assert secrets.redact(f"a ftp://{'u' * n}:{pw}@host/ b") == f"a ftp://{'u' * n}:[SECRET]@host/ b"
    assert secrets.redact("pwd: P@9x,Lq;7vR#2mZ, then") == "pwd: [SECRET], then"
    assert secrets.redact("pwd: " + "as" * 50_000) == "pwd: " + "as" * 50_000  # long, but a walk


def test_secrets_in_lower_case():
    for value in ("qzjxkvbwmtplhr", "correcthorsebatterystaple", "Vkwpqhzmxrtjd"):
        assert secrets.redact(f"pwd: {value} x") == "pwd: [SECRET] x", value
    for text in ("the token is necessary.", "password is incorrect, login is required", "secret is internationally known", "pin: administrator", "password is different"):
        assert secrets.redact(text) == text


def test_guess_cost_is_the_least_at_every_length():
    for times in (12, 14, 500, 20_000):
        assert secrets.guess_cost("xyz12" * times, 100.0) < 10 + math.log10(times), times
        assert secrets.redact("pwd: " + "xyz12" * times) == "pwd: " + "xyz12" * times if times < 100 else True
    rng, letter = random.Random(9), math.log10(26)
    for _ in range(20):  # against a programme over all numbers of spans
        value = "".join(rng.choices(["qwer", "love", "my", "aaa", "abcd", "zx", "dragon"], k=25))
        best = [{0: 0.0}] + [{} for _ in value]
        steps = [*((i, i + 1, letter, 0) for i in range(len(value))), *((*s, 1) for s in secrets.spans_of(value))]
        for i, j, c, one in sorted(steps):
            for k, x in best[i].items():
                best[j][k + one] = min(best[j].get(k + one, math.inf), x + c)
        least = min(c + math.log10(math.factorial(min(k, 20))) for k, c in best[-1].items())
        assert abs(secrets.guess_cost(value) - least) < 1e-9 and abs(secrets.guess_cost(value, 100.0) - min(least, 100.0)) < 1e-9


def cost_by_hand(value):
    """The least cost over all splits, from every span that the rules allow, each found by itself."""
    rank, low, n = secrets.ranks()[0], value.lower(), len(value)
    plain = low.translate(secrets.LEET)
    steps = [(i, i + 1, math.log10(secrets._classes(value)), 0) for i in range(n)]
    for i in range(n):
        for j in range(i + 2, n + 1):
            part = value[i:j]
            if r := rank.get(low[i:j]) or rank.get(plain[i:j]):
                steps.append((i, j, math.log10(r * (1 + (part != low[i:j])) * (1 + (low[i:j] != plain[i:j])) + 1), 1))
            if j - i >= 3 and all(low[k : k + 2] in secrets.NEXT for k in range(i, j - 1)):
                steps.append((i, j, math.log10(len(secrets.NEXT) * (j - i)), 1))
            if j - i >= 3 and {ord(y) - ord(x) for x, y in zip(part, part[1:])} in ({1}, {-1}) and part[1:].isalnum():
                steps.append((i, j, math.log10(52 * (j - i)), 1))
            for size in range(1, (j - i) // 2 + 1):
                times = (j - i) // size
                longest = value[j : j + size] != part[:size]
                if j - i >= 3 and times * size == j - i and part == part[:size] * times and longest:
                    steps.append((i, j, math.log10(secrets._classes(part[:size])) * size + math.log10(times), 1))
        for rx, c in zip(secrets.DATES, secrets.DATE_COST):
            if m := rx.match(value, i):
                steps.append((i, m.end(), c, 1))
    best = [{0: 0.0}] + [{} for _ in value]
    for i, j, c, one in sorted(steps):
        for k, x in best[i].items():
            best[j][k + one] = min(best[j].get(k + one, math.inf), x + c)
    return min(c + math.log10(math.factorial(min(k, 20))) for k, c in best[-1].items())


CORES = ["pass", "password", "passwd", "passphrase", "passcode", "pwd", "pin", "secret", "token", "auth", "credential", "credentials", "login"]
HEADS = "api access private client secret shared session signing account service master encryption".split()
CORES += [h + x + y + z for h in HEADS for x in ("", "_", "-") for y in ("", "access", "access_", "access-") for z in ("key", "secret", "token")]
NAMES = {c + x for c in CORES for x in ["", *(a + b + k for a in ("", "_", "-") for b in ("", "access", "access_", "access-") for k in ("key", "value", "token"))]}
LONGEST_NAME = max(map(len, NAMES))


def quoted_by_hand(text, at, quote):
    """Where a value in quotes ends, if its quote is closed on its line and there is something in it."""
    k = at
    while k < len(text) and text[k] not in (quote, "\n"):
        k += 2 if text[k] == "\\" else 1
        if k > len(text) or text[k - 1] == "\n":
            return None
    return k if at < k < len(text) and text[k] == quote else None


def bare_by_hand(text, at):
    k = at
    while k < len(text) and text[k] not in " \t\n\r\f\v":
        if text[k] in "\"'" and not re.match("[A-Za-z0-9]", text[k + 1 : k + 2]):
            break
        if text[k] == "<":
            end = re.search("[<>\n]", text[k + 1 :])
            body = text[k + 1 : k + 1 + end.start()] if end and end[0] == ">" else ""
            if re.match("/?[A-Za-z!]", body):
                break
        k += 1
    return k


def value_by_hand(text, end):
    """(start, end) of the value behind a name that ends here."""
    k = end + (text[end : end + 1] in ("'", '"') and end < len(text))
    blank = k
    while text[k : k + 1] == " ":
        k += 1
    if text[k : k + 2] in ("=>", ":="):
        k += 2
    elif k < len(text) and text[k] in ":=":
        k += 1
    elif text[k : k + 2].lower() == "is" and not re.match(r"\w", text[k + 2 : k + 3], re.A) and (k > blank or not re.match(r"\w", text[k - 1], re.A)):
        k += 2
    else:
        return None
    while text[k : k + 1] == " ":
        k += 1
    if k < len(text) and text[k] in "\"'":
        if (stop := quoted_by_hand(text, k + 1, text[k])) is not None:
            return k + 1, stop
        k += 1
    stop = bare_by_hand(text, k)
    return (k, stop - (text[stop - 1] in ".,;)")) if stop > k else None


def context_by_hand(text):
    """Starts and ends of all values in credential context, from left to right."""
    out, at, low = [], 0, "".join(c.lower() if c.isascii() else "?" for c in text)
    while at < len(text):
        best = None
        before, here = text[at - 1 : at], text[at : at + 1]
        if not re.match("[A-Za-z0-9]", before) or (re.match("[a-z0-9]", before) and re.match("[A-Z]", here)):
            for n in range(LONGEST_NAME, 0, -1):
                if low[at : at + n] in NAMES and at + n <= len(text):
                    digits = at + n
                    while digits < len(text) and text[digits] in "0123456789":
                        digits += 1
                    if best := value_by_hand(text, digits):
                        break
        if text.startswith("://", at):
            user, colon, rest = text[at + 3 :].partition(":")
            secret = re.match(r"""[^\s/"'<>]+""", rest, re.A) if colon and not re.search(r"""[\s/@"'<>]""", user, re.A) else None
            if secret and secret[0].rfind("@") > 0:
                start = at + 4 + len(user)
                best = (start, start + secret[0].rfind("@"))
        if best:
            out.append(best)
            # a sentence's sign behind the value belongs to what was read
            at = best[1] + (text[best[1] : best[1] + 1] in (".", ",", ";", ")") and not text.startswith(("@",), best[1]))
        else:
            at += 1
    return out


def test_guess_spans_by_hand(spark, sf, documents):
    rng = random.Random(3)
    parts = ["love", "Dragon", "p4ssw0rd", "qwert", "abcd", "4321", "1999-12-31", "xyxy", "aaaa", "kX9", "#", "é", "/012", "<b>", "a<b", "'x", '"', " "]
    heads = ["pwd: ", "token is ", "ftp://me:", "api_key='", 'DB_PASS="', "my clientSecret => ", "secret_access_key:=", "compass: ", '"pin2" : ']
    texts = [d.text or "" for d in documents]
    texts += [f"my {head}{''.join(rng.choices(parts, k=rng.randrange(1, 6)))}{end} rest" for head in heads for end in ("", "!", "'", "@h/", '", b', ".</p>", "\n") for _ in range(12)]
    found = 0
    for text in texts:
        want = []
        for a, b in context_by_hand(text) if re.search("pass|pwd|pin|secret|token|auth|credential|login|key|://", text, re.I) else ():
            if (cost := cost_by_hand(text[a:b])) >= secrets.GUESSES:
                want.append((a, 3, b, round(min(cost, secrets.ENOUGH), 6)))
        got = secrets.scan(text)
        assert [(*x[:3], round(x[3], 6)) for x in got if x[1] == 3] == sorted(want), text
        assert [x[:3] for x in got if x[1] < 3] == base_spans(text)
        found += len(want)
    assert found > 50


def test_places_of_values_on_larger_table(spark, sf):
    """The grammar alone, on every text of a larger table that has a credential word."""
    texts = [r.text for r in spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("text").collect() if r.text]
    for text in texts:
        for m in re.finditer("pass|pwd|secret|token|auth|credential|login|key|://", text, re.I):
            piece = text[max(0, m.start() - 40) : m.end() + 200]
            got = [m.span(m.lastindex) for m in secrets.CONTEXT.finditer(piece)]
            assert [(a, b - (piece[b - 1] in secrets.SENTENCE and piece[a - 1] not in "\"'" and piece[b : b + 1] != "@")) for a, b in got] == context_by_hand(piece), piece


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('pwd: "Xq9<zK2vLm8Tq"', "Xq9<zK2vLm8Tq"),
        ("pwd:'ab\"Kd8#2kz0QpX'", 'ab"Kd8#2kz0QpX'),
        ('password: "correct horse battery staple qz jx"', "correct horse battery staple qz jx"),
        ("DB_PASS=xK9#vQ2mZ7pL3", "xK9#vQ2mZ7pL3"),
        ("MYSQL_PWD: g7#Kq!zX2p", "g7#Kq!zX2p"),
        ("secret_key: xK9vQ2mZ7pL3tt", "xK9vQ2mZ7pL3tt"),
        ("AWS_SECRET_ACCESS_KEY=wJalrXUtn#FEMI/K7MDENG", "wJalrXUtn#FEMI/K7MDENG"),
        ("pwd: Zx9!kQ2#vv!!", "Zx9!kQ2#vv!!"),
        ("pwd: é#9Z!", "é#9Z!"),
        ("<td>password: Zx9!kQ2#vv</td>", "Zx9!kQ2#vv"),
        ("ftp://me:Zx9!kQ2#vv@h/", "Zx9!kQ2#vv"),
        ("token is Xq9zK2vLm8Tq.", "Xq9zK2vLm8Tq"),
        ("http://host:8080/path/x9Kq#2vv", None),
        ("compass: Zx9!kQ2#vv", None),
        ('password: "love"', None),
    ],
)
def test_values_of_real_lines(text, value):
    got = [text[a:b] for a, k, b, _ in secrets.scan(text) if k == 3]
    assert got == ([value] if value else [])
    assert secrets.redact(text) == (text.replace(value, "[SECRET]") if value else text)


def test_secrets_of_an_empty_table(spark):
    from pyspark.sql import functions as F

    none = docs_of(spark, [])
    assert secrets.find_secrets(spark, none).collect() == [] and secrets.without_secrets(spark, none.withColumn("n_chars", F.lit(0))).collect() == []


def test_guess_cost_orders_values():
    cost = secrets.guess_cost
    assert cost("") == 0
    assert cost("password") < cost("password1987") < cost("kX9#mQ2!vB7z")
    assert cost("qwertyuiop") < 5 and cost("aaaaaaaaaaaa") < 5 and cost("abcabcabcabc") < 6 and cost("2021-03-04") < 7
    assert cost("p4ssw0rd") < 4
    letter = math.log10(secrets._classes("İpassword"))
    assert abs(cost("İpassword") - (letter + cost("password"))) < 1e-9  # İ is two characters in lower case

    def brute(value):
        spans = defaultdict(list)
        for i, j, c in secrets.spans_of(value):
            spans[i].append((j, c))
        import math

        letter = math.log10(secrets._classes(value))

        def walk(i, k, c):
            if i == len(value):
                return c + math.log10(math.factorial(k))
            return min([walk(i + 1, k, c + letter), *(walk(j, k + 1, c + x) for j, x in spans[i])])

        return walk(0, 0, 0.0)

    for value in ("love2019x", "abc123abc", "qwe1qwe1", "Pass!word", "zxcvb77"):
        assert abs(cost(value) - brute(value)) < 1e-9, value


# media


def media_by_hand(text):
    raw = (text or "").encode()
    data = raw + bytes(-len(raw) % 64) if raw else bytes(64)
    head = b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(data))
    return len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), 44 + len(data), hashlib.sha256(head + data).hexdigest()


def test_media_over_the_whole_table(spark, sf, documents):
    got = {r.doc_id: r for r in op5_media_chunks(spark, sf).collect()}
    assert len(got) == len(documents)
    for d in documents:
        assert tuple(got[d.doc_id])[1:-1] == media_by_hand(d.text)
    by_text = defaultdict(set)
    for d in documents:
        by_text[d.text].add(tuple(got[d.doc_id])[1:])
    assert all(len(v) == 1 for v in by_text.values())


def test_media_edge_cases(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    texts = [None, "", "a", "é" * 64, "z" * 128, long, long[:70_000] + "edit" + long[70_000:], long, "a"]
    df = docs_of(spark, [(i, t, b"") for i, t in enumerate(texts)] + [(None, "a", b"")], "doc_id long, text string, media binary")
    store = media.MediaStore(spark)
    store.write(df)
    got = media.media_features(spark, df).collect()
    assert len(got) == 10
    for r in got:
        assert tuple(r)[1:-1] == media_by_hand("a" if r.doc_id is None else texts[r.doc_id])
    stored = [r.digest for r in store.store.where("digest is not null").collect()]
    uses = store.uses.groupBy("digest").count().where("count > 1")
    assert len(stored) == len(set(stored)) and set(stored) == {r.digest for r in uses.collect()}
    assert len(stored) > 100  # the edited copy shares most chunks with the first
    held = sum(len(r.sizes) - len(r.shared) for r in store.store.where("media is not null").collect()) + len(stored)
    assert held == store.uses.select("digest").distinct().count()
    assert media.media_features(spark, docs_of(spark, [])).collect() == []


def test_chunks_are_small_and_shared():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ,.") for _ in range(4096)).encode() for _ in range(200)]
    counts = [len(media.cuts(media.payload(t))) for t in texts]
    assert sum(counts) / len(counts) > 4 and min(counts) >= 2 and sum(c >= 3 for c in counts) > 190
    same, chunks = texts[0] + texts[1], []
    for tail in (texts[2], texts[3][:1000]):
        x, at = media.payload(same + tail), 0
        chunks.append(set())
        for end in media.cuts(x):
            chunks[-1].add(media.digest(x[at:end]))
            at = end
    assert len(chunks[0] & chunks[1]) >= 5


def test_a_lost_or_changed_chunk_is_found(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(9000)) for _ in range(3)]
    store = media.MediaStore(spark)
    store.write(docs_of(spark, [(i, t + texts[0]) for i, t in enumerate(texts)]))
    whole = store.store
    assert store.read().count() == 3
    for broken in (whole.where("digest is null"), whole.withColumn("head", F.expr("case when media is not null then encode('RIFX', 'utf-8') end"))):
        store.store = broken
        with pytest.raises(Exception, match="don't give its digest"):
            store.read().count()


def test_gear_cuts():
    rng = random.Random(5)
    data = bytes(rng.randrange(256) for _ in range(100_000))
    ends = media.cuts(data)
    assert ends[-1] == len(data) and all(media.LEAST <= b - a <= media.MOST for a, b in zip([0, *ends], ends[:-1]))
    h, mask = 0, (1 << 32) - 1
    for i, c in enumerate(data[:500]):
        h = (h << 1) + int(media.GEAR[c]) & mask
        assert h == int(media.gear(data[:500])[i])
    shifted = media.cuts(data[:30_000] + b"xyz" + data[30_000:])
    assert len({e + 3 for e in ends} & set(shifted)) > len(ends) // 2
    assert media.cuts(b"") == [] and media.cuts(b"a" * 100) == [100]


# packing


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_packing(rows, texts, capacity=4096):
    tok = tokenizer()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        mine = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(-(-len(ids) // capacity)))
        for r in mine:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * capacity and r.length == min(capacity, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    check_places(rows, capacity)


def check_places(rows, capacity):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    total = sum(r.length for r in rows)
    if rows:
        least = -(-total // capacity)
        assert len(seqs) <= max(least * 1.25 + 1, sum(2 * r.length > capacity for r in rows))
    return seqs


def test_packing_over_the_whole_table(spark, sf, documents):
    check_packing(op8_best_fit_packing(spark, sf).collect(), {d.doc_id: d.text for d in documents})


def test_packing_edge_cases(spark):
    texts = {1: None, 2: "", 3: "a", 4: "Hello WORLD's 123 é  x y \x1c! <|endoftext|> <|startoftext|>z", 5: "word " * 9000, 6: "\n\t  \r", 7: "x" * 50_000, 8: "don't\nstop!\t?!\x85 ok", 9: "ΣΣ İ"}
    df = docs_of(spark, [(i, t, 7) for i, t in texts.items()], "doc_id long, text string, length int")
    check_packing(packing.pack(spark, df).collect(), texts)
    again = packing.pack(spark, docs_of(spark, [(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert len(again) == 3 and len(check_places(again, 4096)) == 1
    assert packing.pack(spark, docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 30), 100]) for _ in range(400)]
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    fill = defaultdict(int)
    for length, lo, hi, first, per, at in packing.plan(histogram, 100):
        for rank in range(hi - lo):
            s, o = first + rank // per, at + rank % per * length
            assert o == fill[s]
            fill[s] += length
            assert fill[s] <= 100
    rooms = []  # one by one
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        r = min(fits) if fits else 100
        if fits:
            rooms.remove(r)
        rooms.append(r - n)
    assert len(fill) == len(rooms)
