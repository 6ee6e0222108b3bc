"""Forms of personal data written out here, apart from the operator's own patterns."""

import re

from gridloom.llm import pii
from gridloom.llm.common import table

from . import brute


def pseudonymised(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.pseudonymise(docs).collect()}
    return [found[i] for i in range(len(texts))]


def each_is_exchanged(spark, values, kind, *around):
    both = [(x, form) for form in around or ["see {} now"] for x in values]
    for (value, form), r in zip(both, pseudonymised(spark, [form.format(x) for x, form in both]), strict=True):
        assert [(x["kind"], x["value"]) for x in r["pii_found"]] == [(kind, value)]
        assert value not in r["text"] and r["text"] == form.format(r["pii_found"][0]["pseudonym"])


def test_every_american_phone_of_the_table_is_exchanged(spark, small):
    docs = table(spark, small.replace("sf0.001", "sf0.1"), "documents").where("text like '%+1 (%'").select("doc_id", "text")
    phone = re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}")
    before = {r["doc_id"]: phone.findall(r["text"]) for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs).collect()}
    assert sum(map(len, before.values())) > 100
    assert not [x for i, numbers in before.items() for x in numbers if x in after[i]]
    assert all(len(phone.findall(after[i])) == len(numbers) for i, numbers in before.items())


def test_phone_forms(spark):
    each_is_exchanged(
        spark,
        ["+1 (017) 555-7713", "+1 132 555 1352", "(743) 555 3824", "(017)555-7713", "743 555 3824", "743-555-3824", "+33 1 23 45 67 89",
         "+33 12 34 56 78 90", "+7 912 345-67-89", "+44 (0)20 7946 0958", "+4915112345678", "+49 30/123456"],
        "phone",
    )


def test_a_phone_takes_in_nothing_of_what_follows(spark):
    texts = ["+44 20 7946 0958 190.137.223.204", "+33 1 23 45 67 89 4785 3805 9239 1139", "+49 30 1234567 2020-02-29"]
    for r, second in zip(pseudonymised(spark, texts), ("ip", "card", "date"), strict=True):
        assert [x["kind"] for x in r["pii_found"]] == ["phone", second]


def test_what_is_none_stays(spark):
    """No phones, and what fails the calendar or its check digits."""
    texts = ["+1 (017) 555-77134", "12 (017) 55-7713", "1,743 555 units", "+12 34", "017 555 7713", "+33 1 23 45",
             "2020/02/30", "31/4/2020", "1.13.2020", "2020-02-29X", "1/5/20205", "ES9121000418450200051333 BIC"]
    assert [r["text"] for r in pseudonymised(spark, texts)] == texts


def test_ibans_whatever_follows(spark):
    values = ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "BE68539007547034",
              "PL61 1090 1014 0000 0712 1981 2874", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32",
              "FR14 2004 1010 0505 0001 3M02 606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    each_is_exchanged(spark, values, "iban", *["see {} " + behind for behind in ("BIC CAIXESBB", "ABCD", "THIS 1234", "x")])


def test_date_forms(spark):
    values = ["2020/02/29", "1/5/2020", "01/05/2020", "25/12/2001", "12/25/2001", "1.5.2020", "31.12.1999", "2020-2-9", "29-02-2020", "2020-02-29"]
    each_is_exchanged(spark, values, "date")
    each_is_exchanged(spark, ["2020-02-29"], "date", "at {}T10:00:00Z", "on {}Z")
    padded = pseudonymised(spark, ["2020/02/29", "02/29/2020", "29.02.2020"])
    assert all(re.fullmatch(r"\d{4}/\d\d/\d\d|\d\d([./])\d\d\1\d{4}", r["text"]) for r in padded)


def test_every_kind_against_brute_force(spark):
    texts = [
        "Card AB12 4111 1111 1111 1111 and a.b-C_d@Sub.Example.org, A.B-C_D@sub.example.ORG", "ip 10.0.0.255, 078-05-1120, 899-99-9999, 001-01-0001, 665-12-3456, 667-12-3456",
        "1/5/2020 2020-02-29 31.12.2099 01.01.1900 12/25/2001 29-02-2020 2020/2/9", "GB82 WEST 1234 5698 7654 32 MT84 MALT 0110 0001 2345 MTLC AST0 01S NO93 8601 1117 947",
        "+49 30 1234 5678 +33 1 23 45 67 89 +1 (017) 555-7713 (743) 555-3824", "x@y.com" + " " + "l" * 64 + "@" + "d" * 63 + ".co.uk", "l" * 65 + "@b.com a@b.com...and x@-.de", "é@b.com ü+49 30 1234567é",
        "AA00 1234 5678 2020-02-29 AB12 1.2.3.4 XX99 9999 a@b.de",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.pseudonymise(docs, brute.KEY).collect()}
    for i, text in enumerate(texts):
        assert found[i]["text"] == brute.pseudonymised(text)
    assert [x["kind"] for x in found[0]["pii_found"]] == ["card", "email", "email"]
    assert "4111 1111 1111 1111" not in found[0]["text"]
    two = [x["pseudonym"].rsplit(".", 1)[0].lower() for x in found[0]["pii_found"][1:]]
    assert two[0] == two[1]


def test_formats_are_permuted_whole(spark):
    """All dates, and all addresses of one small form, go to different ones of the same form."""
    days = spark.range(73_049).selectExpr("cast(date_add(date'1900-01-01', cast(id as int)) as string) as m")
    assert days.select(pii.date_pseudonym(days["m"], "k").alias("p")).distinct().count() == 73_049
    small = spark.range(6760).selectExpr("concat(chr(97 + id % 26), chr(97 + cast(id / 26 as int) % 26), cast(cast(id / 676 as int) as string), '@.de') as m")
    assert small.select(pii.email_pseudonym(small["m"], "k").alias("p")).distinct().count() == 6760
    numbers = spark.range(20_000).selectExpr("concat(lpad(665 + id % 3 - if(id % 3 = 1, 1, 0) * 0 + if(id % 3 > 0, 1, 0), 3, '0'), '-', lpad(1 + id % 99, 2, '0'), '-', lpad(1 + id % 9999, 4, '0')) as m").distinct()
    valid = numbers.where("m not like '666%'")
    out = valid.select(pii.ssn_pseudonym(valid["m"], "k").alias("p"))
    assert out.distinct().count() == valid.count() and out.where("not p rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$'").count() == 0


def test_a_megabyte_of_anything(spark):
    """Long runs of what the patterns repeat: no recursion in the regex, time in proportion to the text."""
    units = ["a.", "@", "a@", "a.b@c", "+44 20 20 ", "4111 1111 1111 1111 ", "1", "1-", "'\"", "AB12 ", "DE89 ", "1.2.3.4.", "12/", "(", "x", "%", "é", "\n", "078-05-1120 ", "2020-02-29 "]
    texts = [x for unit in units for x in ("x@" + unit * (1_000_000 // len(unit)), unit * (1_000_000 // len(unit)) + " a@b.org")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "k").select("doc_id", "text").collect()}
    for i, text in enumerate(texts):
        assert len(found[i]) == len(text)
        assert not found[i].endswith(" a@b.org")


def test_clashing_names_and_empty_tables(spark):
    row = [(1, "a@b.org", "mine", "own", "x", "y")]
    names = "doc_id long, text string, pii_found string, pii_parts string, pii_kinds string, pii_done string"
    docs = spark.createDataFrame(row, names)
    kept = pii.pii_stage(spark, docs, "").first()
    assert kept.asDict() | {"text": ""} == {"doc_id": 1, "text": "", "pii_found": "mine", "pii_parts": "own", "pii_kinds": "x", "pii_done": "y"} and kept["text"] != "a@b.org"
    got = pii.pseudonymise(docs).first()
    assert (got["pii_parts"], got["pii_done"], got["pii_kinds"]) == ("own", "y", {"email": 1})
    assert pii.pii_stage(spark, docs.limit(0), "").count() == 0
    again = pii.pii_stage(spark, docs.union(docs), "").collect()
    assert len(again) == 2 and again[0] == again[1] == kept  # the cluster's key stays the same


def test_no_plan_shows_the_key(spark):
    docs = spark.createDataFrame([(1, "write to a@b.co", "clash")], "doc_id long, text string, pii_key string")
    found = pii.pseudonymise(docs, "a key that nobody reads")
    assert found.columns == ["doc_id", "text", "pii_key", "pii_found", "pii_kinds"] and found.first()["pii_key"] == "clash"
    assert found.first()["text"] != "write to a@b.co"
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    shown = found._jdf.queryExecution().explainString(mode) + found._jdf.queryExecution().toString()
    assert "nobody reads" not in shown
