"""Surrogates: nothing real is left, forms and coreference stay, distinct entities stay distinct."""

from __future__ import annotations

import re

from bazaarlens.llm import pii

TEXT = (
    "Write to jean.34@mail7.example.com or élan.5@mail7.example.com, call +1 (017) 555-7713 or +1 017 555 7713; from"
    ' 97.51.17.173. Card 9807915762804490 4845168114407329, 4845-1681-1440-7329. token = "0cf1bbc67ab39b2ddebadc809bed189ed8c6ac4d".'
    " Mr. Paul Klee met Frau Anna Schmidt, and Mr. Klee left. Version 1.2.3, 12345 and a@b stay."
)


def replaced(spark, rows, key="k"):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_entities string")
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.replace_pii(frame, key).collect()}


def test_forms_stay_and_values_go(spark):
    found = replaced(spark, [(1, TEXT, "x"), (2, TEXT, "y"), (3, None, "z"), (4, "", "z"), (5, "plain text. " * 2000, "z")])
    text, n = found[1]
    assert n == 12 and found[2] == found[1] and found[3] == (None, 0) and found[4] == ("", 0)
    assert found[5] == ("plain text. " * 2000, 0)
    for real in ("jean.34", "élan", "mail7", "017", "7713", "97.51.17.173", "9807915762804490", "4845168114407329", "1681-1440", "0cf1bb", "Klee", "Paul", "Schmidt"):
        assert real not in text
    form = (
        r"Write to [a-z]{4}\.\d\d@([a-z]{4}\d)\.example\.com or [à-ÿœß][a-z]{3}\.\d@\1\.example\.com, call \+1 \((\d{3})\) (\d{3})-(\d{4})"
        r" or \+1 \2 \3 \4; from \d+\.\d+\.\d+\.\d+\. Card 9\d{15} (4\d{3})(\d{4})(\d{4})(\d{4}), \5-\6-\7-\8\. token = \"[0-9a-f]{40}\"\."
        r" Mr\. (\w+) (\w+) met Frau (\w+) \w+, and Mr\. \10 left\. Version 1\.2\.3, 12345 and a@b stay\."
    )
    match = re.fullmatch(form, text)
    assert match, text
    assert match[9] in pii.NAMES_MALE and match[11] in pii.NAMES_FEMALE


def test_key_matters_and_reruns_agree(spark):
    one, same, other = (replaced(spark, [(1, TEXT, "")], key)[1][0] for key in ("k", "k", "l"))
    assert one == same != other


def test_entities_stay_distinct(spark):
    # Two-digit names under one domain: many first draws meet.
    rows = [(i, f"a{i % 10}@x.org b{i % 10}@x.org and {i % 7}@y.org", "") for i in range(70)]
    found = replaced(spark, rows)
    seen = {}
    for i, text, _ in rows:
        for old, new in zip(re.findall(r"\S+@\S+", text), re.findall(r"\S+@\S+", found[i][0]), strict=True):
            assert seen.setdefault(old, new) == new and new not in ("a1@x.org", "b1@x.org")
    assert len(set(seen.values())) == len(seen) == 27


def test_query_leaves_no_entity_and_keeps_the_rest(spark, sf):
    from bazaarlens.llm.queries import op8_pii_surrogates

    known = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\d{1,3}(?:\.\d{1,3}){3}|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b")
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pairs = {}
    for r in op8_pii_surrogates(spark, sf).collect():
        old, new = known.findall(before[r["doc_id"]] or ""), known.findall(r["text"] or "")
        assert len(old) == len(new) == r["n_entities"]
        assert known.split(before[r["doc_id"]] or "") == known.split(r["text"] or "")
        pairs.update(zip(old, new, strict=True))
    assert pairs and len(set(pairs.values())) == len(pairs) and not set(pairs) & set(pairs.values())


def test_no_rows(spark):
    assert replaced(spark, []) == {}


def test_other_scripts_go_and_stay_in_their_script(spark):
    import unicodedata

    def script(c):
        return unicodedata.name(c).split()[0].split("-")[0]

    emails = (
        "王小明@公司名字.cn", "محمد@شركةكبيرة.sa", "דוד@חברהגדולה.il", "राजेश्वर@कंपनी.भारत", "สมชาย@บริษัทใหญ่.th", "김민준@회사이름.kr",
        "さくら@たろうはな.jp", "タロウ@サクラハナ.jp", "ΓΙΩΡΓΟΣ@ΕΤΑΙΡΕΙΑ.gr", "łukaszčš@świętyż.pl", "ngườiviệtạ@đườngộế.vn", "Їжакґє@країнає.ua",
        "արամ@ընկերութ.am", "გიორგი@კომპანია.ge", "ᏣᎳᎩᎯ@ᎠᏂᏴᏫᏯ.us", "𠀀𠀁𠀂𠀃@𠀄𠀅𠀆𠀇.cn", "٣٤٥٦٧٨@१२३४५६.org",
    )
    found = replaced(spark, [(i, f"to {e} now", "") for i, e in enumerate(emails)])
    for i, old in enumerate(emails):
        text, n = found[i]
        new = text.removeprefix("to ").removesuffix(" now")
        (local, domain), (old_local, old_domain) = new.split("@"), old.split("@")
        assert n == 1 and old_local != local and len(old_local) == len(local), (old, new)
        label, old_label = domain.split(".")[0], old_domain.split(".")[0]
        assert label != old_label and len(label) == len(old_label) and domain.endswith(".example." + old_domain.split(".")[1])
        for a, b in zip(old_local + old_label, local + label, strict=True):
            # A script without an alphabet turns Latin.
            assert script(a) == script(b) or (script(a) == "CHEROKEE" and script(b) == "LATIN"), (old, new)
        # By chance a letter may stand for itself, but not many.
        assert sum(a == b for a, b in zip(old_local + old_label, local + label, strict=True)) <= 3, (old, new)


def test_every_letter_and_number_of_an_email_is_known(spark):
    """Letters of all planes, one address for each 200 of them."""
    import unicodedata

    signs = [chr(n) for n in range(0x80, 0x30000) if unicodedata.category(chr(n))[0] in "LMN" and not 0x3400 <= n < 0xD800 and n < 0x20100]
    # Only what the pattern takes in as well: Java may know fewer characters.
    frame = spark.createDataFrame([(c,) for c in signs], "c string")
    from pyspark.sql import functions as F

    taken = frame.where(F.col("c").rlike(rf"^[{pii._WORD}]$"))
    assert taken.count() > 10_000 and taken.where(pii._stand_ins(F.col("c")).isNull()).count() == 0


def test_names_keep_their_script(spark):
    text = "Mr. Иван Петров and Mr. Петров; Frau Мария Петрова; Dr. Ελένη Παππά; Mr. Արամ Սարգսյան; Mr. Paul Иванов."
    new, n = replaced(spark, [(1, text, "")])[1]
    form = (
        r"Mr\. ([А-яё]+) ([А-Яа-я]+) and Mr\. \2; Frau ([А-Яа-я]+) [А-Яа-я]+; Dr\. ([Ά-ώ]+) [Ά-ώ]+;"
        r" Mr\. [Ա-ֆ]{4} [Ա-ֆ]{8}; Mr\. ([A-Z][a-z]+) [А-Яа-я]+\."
    )
    match = re.fullmatch(form, new)
    assert n == 6 and match, new
    male, female, _ = pii.NAMES_BY_SCRIPT["Cyrillic"]
    assert match[1] in male and match[3] in female and match[4] in pii.NAMES_BY_SCRIPT["Greek"][2] and match[5] in pii.NAMES_MALE
    for real in ("Петров", "Παππά", "Սարգսյան", "Иванов"):
        assert real not in new


def test_numbers_in_groups_go(spark):
    text = "555-123-4567, 1-555-123-4567; 555.123.4567. 0171 2345678 and 0171/2345678, 123-45-6789."
    kept = "2024-05-06, 1.2.3, 10-20-30, 555-1234, 12-555-123-4567-8, 192-168, x555-123-4567, 100 200 3000"
    new, n = replaced(spark, [(1, text, ""), (2, kept, "")])[1]
    match = re.fullmatch(r"(5\d\d)-(\d{3})-(\d{4}), 1-\d{3}-\d{3}-\d{4}; \1\.\2\.\3\. (0\d{3}) (\d{7}) and \4/\5, 1\d\d-\d\d-\d{4}\.", new)
    assert n == 6 and match, new
    assert not any(real in new for real in ("123-4567", "123.4567", "2345678", "45-6789"))
    assert replaced(spark, [(2, kept, "")])[2] == (kept, 0)


def test_crowded_forms_end_and_stay_distinct(spark):
    rows = [(10 * i + j, f"to {i}@{j}.com.", "") for i in range(10) for j in range(10)]
    found = [text.removeprefix("to ").removesuffix(".") for text, _ in replaced(spark, rows).values()]
    assert len(set(found)) == 100 and not {f"{i}@{j}.com" for i in range(10) for j in range(10)} & set(found)
    domains = {}
    for key, (text, _) in replaced(spark, rows).items():
        domains.setdefault(key % 10, set()).add(text.split("@")[1])
    assert all(len(d) == 1 for d in domains.values()) and len({*map(min, domains.values())}) == 10


def test_families_stay_families(spark):
    names = ["Adam", "Bert", "Carl", "Dave", "Egon", "Fred", "Gert", "Hans", "Ivo", "Jan", "Kurt", "Leo", "Max", "Noel", "Otto", "Pit", "Rolf", "Sven", "Tim", "Udo"]
    rows = [(i, f"Mr. {n} Klee came. Mr. Klee left with Dr. {n} Meier.", "") for i, n in enumerate(names)]
    found = replaced(spark, rows)
    form = re.compile(r"Mr\. (\w+) (\w+) came\. Mr\. (\w+) left with Dr\. (\w+) (\w+)\.")
    parts = [form.fullmatch(found[i][0]).groups() for i in range(20)]
    assert {p[1] for p in parts} == {p[2] for p in parts} and len({p[1] for p in parts}) == 1
    assert len({p[4] for p in parts}) == 1 and parts[0][4] != parts[0][1]
    assert len({p[0] for p in parts}) == 20 and len({p[3] for p in parts}) == 20


def test_emails_of_one_domain_stay_together(spark):
    rows = [(i, f"u{i % 100}x{i // 100}@mail.org and a{i}@shop{i % 7}.net", "") for i in range(3000)]
    found = replaced(spark, rows)
    pairs = [re.findall(r"(\S+)@(\S+)", found[i][0]) for i in range(3000)]
    assert len({p[0][1] for p in pairs}) == 1 and len({p[0][0] for p in pairs}) == 3000
    assert [len({p[1][1] for p in pairs[k::7]}) for k in range(7)] == [1] * 7 and len({p[1][1] for p in pairs}) == 7
    assert len({p[1] for p in pairs}) == 3000
