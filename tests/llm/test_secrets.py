"""Secret scans against a plain reading of the base rules, and the lexer on source text."""

import hashlib
import random
import re
import time

from lodestar.llm import secrets
from tests.llm.helpers import empty_docs, odd_docs


def plain_spans(text):
    """The base rules as they are worded: every match, failing ones dropped."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_equal_the_rules():
    rng = random.Random(4)
    bits = ["password", "Secret", "apikey", "API_KEY", "token", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEF0123456789XY", "é", "\n", "deadbeef", "-", "zzz", "0" * 20]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert secrets.join_spans(secrets.base_spans(text)) == plain_spans(text), text


def test_lexer_follows_names_and_concatenations():
    text = 'part = "Xk29-Qm44z"\ndb_password = part + "Lw77-Pq13"\ncolor = "Xk29-Qm44z-blue"\nconfig:\n  private_key: Zx81Yq93Wd47Vs20\n'
    found = {text[a:b] for k, a, b in secrets.scan(text)[1] if k == "literal"}
    assert {"Xk29-Qm44z", "Lw77-Pq13", "Zx81Yq93Wd47Vs20"} <= found
    assert not any("blue" in f for f in found)
    assert secrets.literal_spans('title = "A plain sentence about a password"\nkey: value\npassword: changeme\n') == []


def test_long_texts_take_linear_time():
    for text in ("x" * 300_000 + " = 1", "token = abcdefgh12345678\n" * 20_000, "a.b-c_" * 60_000 + ":", "password " * 50_000 + "=", 'k="' * 50_000):
        secrets.scan(text)


def plain_literals(text):
    """The lexer with every binding's literals copied out in full."""
    found, bound, offset = set(), {}, 0
    for line in text.split("\n"):
        for m in secrets._PAIR.finditer(line):
            places, at = [], offset + m.start("rhs")
            for t in secrets._TERM.finditer(m["rhs"]):
                g = t.lastindex
                places += bound[t[3]] if g == 3 and t[3] in bound else [(at + t.start(g), at + t.end(g))]
            bound[m["name"]] = places = list(dict.fromkeys(places))
            value = "".join(text[a:b] for a, b in places)
            if secrets.name_weight(m["name"]) * secrets.literal_shape(value) >= secrets.THRESHOLD:
                found |= {("literal", a, b) for a, b in places if b > a}
        offset += len(line) + 1
    return found


def test_literals_equal_the_plain_lexer():
    rng = random.Random(9)
    names = ["a", "part", "db_password", "token", "color", "secret_key"]
    for _ in range(1500):
        lines = []
        for k in range(rng.randint(1, 9)):
            # each name is used once in an expression and never in its own, so that no literal meets itself
            terms = [f'"{rng.choice("abXY19-+_")}{k}{rng.choice(["Qz7", "hello wo", "k29-Qm44zLw77", ""])}"' for _ in range(rng.randint(0, 2))]
            terms += [rng.choice(names)] if rng.random() < 0.5 or not terms else []
            rng.shuffle(terms)
            lines.append(f"{rng.choice(names)} = {' + '.join(terms)}")
        text = "\n".join(lines)
        got = secrets.literal_spans(text)
        assert set(got) == plain_literals(text), text
        assert len(got) == len(set(got))


def test_chains_take_linear_time():
    """Growing, renamed and doubling chains: ten times the lines take about ten times as long."""

    def seconds(make, n):
        text = make(n)
        start = time.perf_counter()
        spans = secrets.literal_spans(text)
        return time.perf_counter() - start, len(spans)

    def grown(n):
        return 'token = "Xk29-Qm44z"\n' + "".join(f'token = token + "x{i}"\n' for i in range(n))

    def renamed(n):
        return 'token_0 = "Xk29-Qm44z"\n' + "".join(f'token_{i + 1} = token_{i} + "x{i}"\n' for i in range(n))

    def doubled(n):
        return 'token = "Xk29-Qm44z"\npart = "Lw77"\n' + "part = part + token\ntoken = token + part\n" * n

    for make in (grown, renamed, doubled):
        few, _ = seconds(make, 3_000)
        many, found = seconds(make, 30_000)
        assert many < 40 * few + 1, (make.__name__, few, many)
        assert found >= (2 if make is doubled else 30_000)


def test_rows(spark):
    docs = odd_docs(spark, [None, "", "token = abcdefgh12345678 and more", "token = abcdefgh12345678 and more", "x" * 200_000 + " secret: 0123456789abcdef0123"])
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == docs.count()
    for r, text in ((r, {d.doc_id: d.text for d in docs.collect()}[r.doc_id] or "") for r in rows):
        assert r.base_sha256 == hashlib.sha256(plain_spans(text).encode()).hexdigest()
        assert set(filter(None, plain_spans(text).split(","))) <= set(r.spans.split(","))
    assert secrets.find_secrets(empty_docs(spark)).count() == 0


def test_redaction_leaves_clean_rows_alone(spark):
    docs = odd_docs(spark, [None, "", "clean text", "a token = abcdefgh12345678 b"])
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[0] == (None, None) and texts[2] == ("clean text", 10)
    assert texts[3] == ("a [SECRET] b", len("a [SECRET] b"))
    assert not secrets.scan(texts[3][0])[0]


def test_every_listed_name_can_have_a_finding():
    rng = random.Random(11)
    for part in secrets.SENSITIVE:
        for name in (part, f"my_{part}", f"{part.upper()}_2"):
            for signs in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz-_!", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"):
                literal = signs[0] + signs[-1] + "".join(rng.choice(signs) for _ in range(38))
                for text in (f'{name} = "{literal}"', f"x: 1\n{name}: {literal}\n"):
                    assert literal not in secrets.redact(text), text
    for text in ('session_cookie = "k3v9q0x7m2z8w5t1r6y4p0aj"', 'dsn = "db://app:qwxzvkjhgfdptrm@host/main"', 'signing_key = "0F9A37C2B8D4E1650F3A92C7B1D8E4560A9F3C7E2B8D4165F0A39C72B18D4E65"'):
        assert secrets.literal_spans(text), text
    assert secrets.literal_spans('key: primary-button\nsort_key = "created_at"\ncache_key: user_profile\nauthor: someone-with-a-long-name\n') == []
