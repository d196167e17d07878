from __future__ import annotations

import hashlib
import random
import re

from pageloom.llm import pii as P


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m)) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def listed(docs, *kinds):
    return {r.doc_id: r.s for r in P.find(docs).select("doc_id", P.listed(kinds or None).alias("s")).collect()}


def test_base_spans(documents, odd_texts):
    rng = random.Random(5)
    parts = [*"aZ9@.-+% ()\n1é4", "1.2", "4111 1111 1111 1111", "@b.c", "5500-0000-0000-0004", "+49 30 "]
    texts = odd_texts[:10] + odd_texts[-1:]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["1." * 3000 + "1", "a." * 5000 + "@" + "b." * 5000 + "c", "1 " * 20000, "+" * 50 + "1 " * 50, "x@y.z " * 1000, "a@b@c.d", "000000255.0.0.1 256.1.1.1", "9" * 30000]
    got = listed(documents(texts), *P.BASE)
    assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]


def test_added_kinds_need_checksum_or_context(documents):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 x", "DE89 3704 0044 0532 0130 01", "ssn 123-45-6789", "part 123-45-6789", "GB82WEST12345698765432"]
    assert [listed(documents(texts))[i] for i in range(5)] == ["iban:5:32", "", "national:4:15", "", "iban:0:22"]
    score = P.find(documents(["4111111111111111", "visa 4111111111111111"])).orderBy("doc_id").collect()
    assert score[0].spans[0].score < score[1].spans[0].score


def test_ibans_end_by_their_country(documents):
    tight, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    texts = [f"{spaced} Please pay", f"{tight} Thanks", f"{spaced} BIC COBADEFFXXX", f"{spaced} 2024", f"{spaced} {tight}", f"{spaced}A", "NO93 8601 1117 947 Oslo", "AB12 REF " + tight + "."]
    want = ["iban:0:27", "iban:0:22", "iban:0:27", "iban:0:27", "iban:0:27,iban:28:50", "", "iban:0:18", "iban:9:31"]
    got = listed(documents(texts), "iban")
    assert [got[i] for i in range(len(texts))] == want
    assert P.redact(documents(texts[:1])).first().text == "[IBAN] Please pay"


def test_redaction(documents):
    docs = documents(["a@b.co é +49 10.200.30.41 end", None, "", "nothing 12", "x@y.z " * 3])
    out = P.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: "[EMAIL] é [PHONE] end", 1: None, 2: "", 3: "nothing 12", 4: "[EMAIL] " * 3}
    assert out.where("text LIKE '%[EMAIL]%'").count() == 2


def test_no_python_on_the_way(spark, documents):
    plan = P.redact(documents(["a"])).select("text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan.replace("ExistingRDD", "").replace("PythonRDD", ""))


def test_digest_and_empty(spark, documents, tmp_path):
    documents(["a@b.co", None]).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in P.op3_pii(spark, str(tmp_path)).collect()}
    assert got[0].base_sha256 == hashlib.sha256(b"email:0:6").hexdigest() and got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[0].n_email == 1
    assert P.find(documents([])).count() == 0
