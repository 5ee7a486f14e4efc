import re

from pyspark.sql import functions as F

from shoptrail.llm import surrogates

TEXT = (
    "Mr. John Smith (john.smith@mail.com, 10.0.0.1) met Mrs. Anna Smith. Smith said: call +1 (386) 555-3733 or 386-555-3733. "
    "John paid with 4111 1111 1111 1111 and 4111111111111111; JOHN.SMITH@MAIL.COM password=e3b3ed3cc8548923d6 IBAN DE89 3704 0044 0532 0130 00."
)


def replaced(docs, key="k"):
    return {r["doc_id"]: r for r in surrogates.pseudonymised(docs, key).collect()}


def test_types_formats_and_coreference(docs_of):
    row = replaced(docs_of([(1, TEXT)]))[1]
    new = row["text"]
    for real in ("John", "Anna", "Smith", "smith", "10.0.0.1", "555-3733", "4111", "e3b3ed", "3704", "mail.com"):
        assert real not in new, (real, new)
    names = re.match(r"Mr\. (\w+) (\w+) \((\S+), (\d+\.\d+\.\d+\.\d+)\) met Mrs\. (\w+) (\w+)\. (\w+) said", new)
    assert names and names[2] == names[6] == names[7] and names[1] != names[5]
    assert names[1].endswith(tuple(surrogates.ENDINGS["latin"]["m"])) and names[5].endswith(tuple(surrogates.ENDINGS["latin"]["f"]))
    assert f"{names[1]} paid" in new and names[3].upper() in new
    phones = re.search(r"\+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3})-(\d{3}-\d{4})", new)
    assert phones and phones[1] == phones[3] and phones[2] == phones[4]
    cards = re.search(r"with ([\d ]{19}) and (\d{16});", new)
    assert cards and cards[1].replace(" ", "") == cards[2] and cards[2][0] == "4"
    digits = [int(d) for d in cards[2][::-1]]
    assert sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"password=[0-9a-f]{18} IBAN DE[0-9]{2}( [0-9]{4}){4} [0-9]{2}\.$", new)


def test_scripts(docs_of):
    row = replaced(docs_of([(1, "господин Иван Петров и госпожа Анна Петров"), (2, "κύριος Παπάς")]))
    names = re.fullmatch(r"господин ([А-Я][а-я]+) ([А-Я][а-я]+) и госпожа ([А-Я][а-я]+) \2", row[1]["text"])
    assert names and not {"Иван", "Анна", "Петров"} & set(names.groups())
    assert names[1].endswith(tuple(surrogates.ENDINGS["cyrillic"]["m"])) and names[3].endswith(tuple(surrogates.ENDINGS["cyrillic"]["f"]))
    assert re.fullmatch(r"κύριος [Α-Ω][α-ωάέήίόύώ]+", row[2]["text"]) and "Παπάς" not in row[2]["text"]


def test_whole_names_are_replaced(docs_of):
    names = [
        "Dr. Anna Maria Schmidt", "Mr. McDonald", "Ms. Mary-Jane Watson", "Mr. John F. Kennedy", "Mr. O'Neil", "Ms. Li", "Mr. J.-P. O’Hara",
        "Prof. Dr. Ludwig van der Berg", "Mrs. Ana Lucia Maria DeSouza-Smith", "Mr. SMITH", "Monsieur d'Artagnan",
    ]
    rows = replaced(docs_of([(i, f"Then {name} came, and {name.split()[-1]}'s friend.") for i, name in enumerate(names)]))
    for i, name in enumerate(names):
        new = re.fullmatch(r"Then (\S+ (?:Dr\. )?)(.+) came, and (.+)'s friend\.", rows[i]["text"])
        assert new and name.startswith(new[1]) and rows[i]["replaced"] == 2, (name, rows[i])
        old, words = name.removeprefix(new[1]).split(), new[2].split()
        assert len(words) == len(old) and words[-1] == new[3] != old[-1], (name, rows[i])
        for a, b in zip(old, words):
            assert (a == b) == (a in ("van", "der")) or "." in a, (name, rows[i])
            assert [c for c in a if c in ".-"] == [c for c in b if c in ".-"] or "." not in a
    assert re.search(r"Mr\. [A-Z][a-z]+ [A-Z]\. [A-Z][a-z]+ came", rows[3]["text"]) and re.search(r"Mr\. [A-Z]\.-[A-Z]\. [A-Z][a-z]+ came", rows[6]["text"])


def test_names_end_where_they_end(docs_of):
    text = "Mr. Smith's dog; Mr. Smith I know, Smith-Jones is no Mrs. Ann Smith-Jones Mr. Don Jones"
    new = replaced(docs_of([(1, text)]))[1]["text"]
    found = re.fullmatch(r"Mr\. (\w+)'s dog; Mr\. \1 I know, (\w+) is no Mrs\. (\w+) \2 Mr\. (\w+) (\w+)", new)
    assert found and len(set(found.groups())) == 5 and not {"Smith", "Jones", "Ann", "Don"} & set(found.groups()), new


def test_same_everywhere_and_by_key(docs_of):
    docs = docs_of([(i, f"mail to someone.{i % 3}@host{i % 2}.org now") for i in range(12)])
    one, two, other = replaced(docs), replaced(docs), replaced(docs, "another")
    assert one == two and all(one[i]["text"] != other[i]["text"] for i in one)
    assert len({r["text"] for r in one.values()}) == 6
    domains = {i: one[i]["text"].split("@")[1] for i in one}
    assert len(set(domains.values())) == 2 and domains[0] == domains[2] != domains[1]


def test_surrogates_are_distinct_and_no_real_values(spark, monkeypatch):
    """With a generator that often repeats itself, collisions are mended and the first keeps its surrogate."""
    rows = [("ip", f"10.0.0.{i}") for i in range(12)] + [("name", f"name{i}") for i in range(12)]
    entities = spark.createDataFrame(rows, "kind string, norm string")
    real = surrogates._surrogate

    def few(key):
        number = F.conv(F.substring(F.sha2(F.concat_ws("|", "kind", "norm", "attempt"), 256), 1, 6), 16, 10).cast("bigint") % 20
        return F.when(F.col("kind") == "ip", F.concat(F.lit("10.0.0."), (number + 6).cast("string"))).otherwise(real(key))

    monkeypatch.setattr(surrogates, "_surrogate", few)
    found = surrogates.surrogate_table(entities, "k").collect()
    pools = {}
    for r in found:
        pools.setdefault("ip" if r["kind"] == "ip" else "name", []).append(r["surrogate"])
    assert len(found) == 24 and all(len(set(v)) == len(v) for v in pools.values())
    assert not set(pools["ip"]) & {r[1] for r in rows} and not set(pools["name"]) & {f"name{i}" for i in range(12)}


def test_a_used_up_format_still_gets_distinct_surrogates(spark):
    rows = [("email", f"{chr(97 + i)}@{chr(97 + j)}.org") for i in range(26) for j in range(4)]
    found = surrogates.surrogate_table(spark.createDataFrame(rows, "kind string, norm string"), "k").collect()
    assert len({r["surrogate"] for r in found}) == len(rows) and not {r["surrogate"] for r in found} & {r[1] for r in rows}


def test_clean_texts_stay(docs_of):
    texts = ["No one is here.", "Version 1.2.3 of 2024-01-05, 100,000 rows", "a@b", "# 12 34", "Mr. who", "1.2.3.4.5"]
    rows = replaced(docs_of(list(enumerate(texts))))
    assert [rows[i]["text"] for i in range(len(texts))] == texts and not any(r["replaced"] for r in rows.values())


def test_odd_rows(odd_docs, docs_of):
    result = surrogates.pseudonymised(odd_docs, "k")
    assert set(result.columns) == set(odd_docs.columns)
    assert sorted(map(str, (r["text"] for r in result.collect()))) == sorted(map(str, (r["text"] for r in odd_docs.collect())))
    twice = docs_of([(1, "a@b.com"), (1, "a@b.com"), (None, "c@d.com and a@b.com"), (2, "x@y.com " * 3000)])
    rows = surrogates.pseudonymised(twice, "k").collect()
    assert len(rows) == 4 and sorted(r["replaced"] for r in rows) == [1, 1, 2, 3000]
    assert surrogates.pseudonymised(docs_of([]), "k").collect() == []


def test_long_domains_and_odd_ends(docs_of):
    texts = ["x@" + "a." * 100_000 + "com", "to a@b.com.", "to a@b.com-", "to a@b.co.2024 now", "to a@b-c.de, ok", "x@" + "a." * 100_000 + "1", "1 " * 100_000]
    got = {r["doc_id"]: r["text"] for r in surrogates.pseudonymised(docs_of(list(enumerate(texts))), "k").collect()}
    assert all(got[i] != texts[i] for i in range(5)) and got[6] == texts[6]
    assert got[1].endswith(".com.") and got[2].endswith(".com-") and got[3].endswith(".2024 now") and "b-c.de" not in got[4]


def test_one_person_keeps_one_name(docs_of):
    """Titles of other gender, capitals, and a given name alone do not make another person."""
    rows = replaced(docs_of([
        (1, "Dr. Anna Weber left. Mrs. Anna Weber came, and ANNA WEBER went."), (2, "Mr. SMITH and Mr. Smith; Smith said SMITH is no smith."),
        (3, "Mr. John Smith saw Mr. John, and John."), (4, "Mrs. McDonald, McDonald, MCDONALD and Mr. Anna"),
    ]))
    one = re.fullmatch(r"Dr\. (\w+) (\w+) left\. Mrs\. \1 \2 came, and (\w+) (\w+) went\.", rows[1]["text"])
    assert one and (one[3], one[4]) == (one[1].upper(), one[2].upper()) and "Anna" not in rows[1]["text"]
    assert one[1][0].isupper() and one[1][1:].islower()
    two = re.fullmatch(r"Mr\. (\w+) and Mr\. (\w+); \2 said \1 is no smith\.", rows[2]["text"])
    assert two and two[1] == two[2].upper() and two[2] != "Smith"
    three = re.fullmatch(r"Mr\. (\w+) (\w+) saw Mr\. \1, and \1\.", rows[3]["text"])
    assert three and three[2] == two[2] and three[1].lower().endswith(tuple(surrogates.ENDINGS["latin"]["m"]))
    four = re.fullmatch(r"Mrs\. (\w+), \1, (\w+) and Mr\. (\w+)", rows[4]["text"])
    assert four and four[2] == four[1].upper() and four[3] == one[1]
    assert one[1].lower().endswith(tuple(surrogates.ENDINGS["latin"]["f"]))
