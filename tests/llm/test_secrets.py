import base64
import hashlib
import json
import re

from marketlens.llm import secret_scan, spans
from marketlens.llm.queries import op3_structural_secrets
from tests.llm.common import DOCS, SMALL, docs, texts


def base(text):
    out = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 16]
    return sorted(out)


def test_base_columns(spark):
    got = {r.doc_id: r for r in op3_structural_secrets(spark, SMALL).collect()}
    rows = texts()
    assert len(got) == len(rows)
    for d, t in zip(rows.doc_id, rows.text, strict=True):
        want = base(t)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert got[d].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert got[d].n_assign == sum(w[2] == "assign" for w in want) and got[d].n_hex == sum(w[2] == "hex" for w in want)
        assert joined in got[d].spans or set(joined.split(",")) <= set(got[d].spans.split(","))
    assert any(r.spans for r in got.values())


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82, size >> 8, size & 255])
    return bytes([tag]) + head + body


def number(n):
    raw = n.to_bytes(n.bit_length() // 8 + 1)
    return der(2, raw)


RSA = der(0x30, number(0) + b"".join(number(3 ** (40 * i) + 7) for i in range(1, 9)))
PKCS8 = der(0x30, number(0) + der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(4, RSA))


def part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).rstrip(b"=").decode()


def kinds(text):
    return {k for k, _, _ in secret_scan.find(text)}


def test_structures():
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    assert "jwt" in kinds(f"see {token} there")
    assert "jwt" not in kinds(f"{part({'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl")
    assert secret_scan.key_kind(RSA) == "rsa" and secret_scan.key_kind(PKCS8) == "pkcs8"
    for key in (RSA, PKCS8):
        assert "der" in kinds("blob " + base64.b64encode(key).decode())
        assert "der" in kinds("blob " + key.hex())
        assert "der" not in kinds("blob " + base64.b64encode(key[:-3]).decode())  # lengths that don't fit
        body = "\n".join(re.findall(".{1,64}", base64.b64encode(key).decode()))
        armoured = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
        assert "pem" in kinds(armoured)
        assert "pem" not in kinds(armoured.replace(body, "bm90IGEga2V5"))
    assert "encoded" in kinds(base64.b64encode(b"the password: hunter2hunter2 is old").decode())
    assert kinds(base64.b64encode(b"just some harmless words in a row").decode()) <= {"hex"}
    assert kinds("ſecret=abcdefghijklmnop Key") == set()  # letters that only Unicode folds to ASCII


def test_awkward_rows(spark):
    got = secret_scan.scan(docs(spark)).select("doc_id", "spans").collect()
    assert len(got) == 18 and all(r.spans == [] for r in got if r.doc_id in (1, 2, 3))
    assert secret_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_redaction(spark):
    rows = [(1, "a 😀 password=abcdefabcdefabcdef01 b"), (2, None), (3, "clean text")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.redact(secret_scan.scan(table)).collect()}
    assert got == {1: "a 😀 [REDACTED] b", 2: None, 3: "clean text"}


def test_token_before_a_full_stop():
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    five = f"{part({'alg': 'dir', 'enc': 'A128GCM'})}..aXY.Y2lwaGVy.dGFn"
    for end in ("", ".", ". Next", "...", ".txt", ".tar.gz", "." + token):
        text = f"the token is {token}{end}"
        assert ("jwt", 13, 13 + len(token)) in secret_scan.find(text), end
        assert ("jwt", 0, len(five)) in secret_scan.find(five + end), end
    joined = [s for s in secret_scan.find(f"eyJunk.{token}.{token}") if s[0] == "jwt"]
    assert joined == [("jwt", 7, 7 + len(token)), ("jwt", 8 + len(token), 8 + 2 * len(token))]


def test_wrapped_keys():
    for key in (RSA, PKCS8, PKCS8 + b""):
        whole = base64.b64encode(key).decode()
        for width in (40, 64, 76):
            for glue in ("\n", "\r\n", "\n    "):
                lines = [whole[i:i + width] for i in range(0, len(whole), width)]
                body = glue.join(lines)
                for before, after in (("", ""), ("key: ", "\nThanks"), ("A line of text\n", "\n\nmore"), ("x\n", " and so on\n")):
                    got = secret_scan.find(before + body + after)
                    assert ("der", len(before), len(before) + len(body)) in got, (width, glue, before)
    # a first line that is shorter by what stands before it
    body = whole[:50] + "\n" + "\n".join(whole[50 + i:114 + i] for i in range(0, len(whole) - 50, 64))
    assert ("der", 5, 5 + len(body)) in secret_scan.find("key: " + body + "\n")
    # lines of other data are no key
    other = base64.b64encode(bytes(i * 89 & 255 for i in range(600))).decode()
    assert not kinds("\n".join(other[i:i + 64] for i in range(0, len(other), 64))) & {"der", "encoded"}


def test_long_adversarial_texts_take_linear_time():
    """Runs that begin a token at every third letter, and dotted chains that are never one."""
    import time
    for text in ("eyJ" * 1_600_000, "eyJ." * 300_000, "eyJa.b.c." * 100_000, "xeyJ-" * 400_000 + ".a"):
        start = time.time()
        secret_scan.find(text)
        assert time.time() - start < 20, text[:9]


def test_tokens_inside_longer_runs():
    import base64
    import json

    def part(x):
        return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")

    token = f"{part({'alg': 'HS256'})}.{part({'sub': 'a'})}.c2ln"
    for before, after in (("", ""), ("zz", " x"), ("a.b.", ""), ("eyJx.y.", "."), ("eyJeyJ ", ".z"), ("zzeyJ.", "")):
        found = [s for s in secret_scan.find(before + token + after) if s[0] == "jwt"]
        assert found == [("jwt", len(before), len(before) + len(token))], (before, after)
