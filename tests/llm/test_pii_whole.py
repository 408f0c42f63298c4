"""Valid values that stayed in clear text, whole or in part."""

import re

from pagemill.llm import pii


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def mod97(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def test_no_valid_value_stays(spark, documents):
    long = "aB3" * 400
    parts = [("", "password: ", "correcthorse", " and more"), ("x ", 'secret: "', "correct-horse-battery", '"'), ("", "token=", long, ", 1"),
             ("", "token=", "abcdefgh.ijklmnop.qrstuvwx", ". Next"), ("", "", "415-555-2671", "."), ("", "1-", "415-555-2671", ""), ("", "", "415.555.2671", " x")]
    ibans = [("ES91 2100 0418 4502 0005 1332", " BIC"), ("BE68 5390 0754 7034", " EUR"), ("BE68539007547034", " BANK OF"),
             ("GB82 WEST 1234 5698 7654 32", " BIC"), ("BE68 5390 0754 7034", " ES9121000418450200051332 X")]
    texts = ["".join(p) for p in parts] + [f"to {i}{after}" for i, after in ibans]
    got = {r.doc_id: r for r in pii.pseudonymise(documents(texts), "k").collect()}
    for i, (before, name, value, after) in enumerate(parts):
        new = got[i].text
        assert new.startswith(before + name) and new.endswith(after) and shape(new) == shape(texts[i])
        new = new[len(before + name) : len(new) - len(after)]
        assert got[i].n_pseudonyms == 1 and new != value
        assert all(new[k : k + 10] != value[k : k + 10] for k in range(0, len(value) - 9, 10)), value
    for i, (value, after) in enumerate(ibans, len(parts)):
        new = got[i].text[3 : 3 + len(value)]
        assert new != value and new[:2] == value[:2] and shape(new) == shape(value) and mod97(new) == 1
        assert i == len(texts) - 1 or got[i].text[3 + len(value) :] == after
    last = got[len(texts) - 1]
    assert last.n_pseudonyms == 2 and "ES9121000418450200051332" not in last.text


def test_what_is_no_such_value_stays(spark, documents):
    texts = ["115-555-2671", "415-555-26711", "415-155-2671", "9-415-555-2671", "ES91 2100 0418 4502 0005 1333 BIC", "password: short", "the password was long: 1"]
    assert [r.text for r in pii.pseudonymise(documents(texts), "k").orderBy("doc_id").collect()] == texts


FORMS = ["+1 415-555-2671", "+14155552671", "415-555-2671", "(415) 555-2671", "1-415-555-2671", "415.555.2671", "+1 (415) 555 2671"]


def values(got, n):
    return [re.sub("[^0-9A-Z]", "", got[i].removeprefix("so ").removesuffix(", then")) for i in range(n)]


def replaced(documents, texts):
    return {r.doc_id: r.text for r in pii.pseudonymise(documents(texts), "k").collect()}


def test_forms_of_one_number_stay_linked(documents):
    got = replaced(documents, [f"so {f}, then" for f in FORMS])
    assert all(re.sub("[0-9]", "9", got[i]) == re.sub("[0-9]", "9", f"so {f}, then") for i, f in enumerate(FORMS))
    found = values(got, len(FORMS))
    national = {v[-10:] for v in found}
    assert len(national) == 1 and "4155552671" not in national and re.fullmatch("[2-9]..[2-9].{6}", national.pop())
    assert [v[:-10] for v in found] == ["1", "1", "", "", "1", "", "1"]
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"]
    found = values(replaced(documents, [f"so {f}, then" for f in ibans]), 4)
    assert found[0] == found[1] != ibans[0] and found[2] == found[3] != ibans[3]
    abroad = ["+442079460958", "+44 20 7946 0958", "+44 (20) 7946-0958", "+35312345678"]
    found = values(replaced(documents, [f"so {f}, then" for f in abroad]), 4)
    assert found[0] == found[1] == found[2] != "442079460958" and found[0][:2] == "44" and found[3][:3] == "353"


def test_ranges_are_kept_and_values_told_apart(documents):
    ssns = [f"{a:03d}-{g:02d}-{n:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for n in range(1, 9999, 400)]
    got = list(replaced(documents, ssns).values())
    assert len(set(got)) == len(ssns) and not any(re.search("^(000|666|9..)-|-00-|-0000$", v) for v in got)
    phones = [f"{a}-{b}-{n:04d}" for a in (200, 415, 999) for b in (200, 555, 999) for n in range(0, 9999, 500)]
    got = list(replaced(documents, phones).values())
    assert len(set(got)) == len(phones) and all(re.fullmatch("[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}", v) for v in got)


def test_secrets_but_not_prose(documents):
    prose = ["the secret: everything is calm", "a token: something wonderful", "Secret: everything = 1", "the token: wonder_ful 12"]
    assert list(replaced(documents, prose).values()) == prose
    secrets = [("Password: ", "hunter2abc"), ("api_key='", "abcd1234efgh"), ("token: ", "abcdefgh1"), ("secret: \"", "everything"), ("password: ", "correcthorse"),
               ("ghp_", "a1B2" * 9), ("sk-", "Zx9" * 12), ("secret: ", "q" * 64), ("TOKEN=", "abcdefgh")]
    got = replaced(documents, [f"x {lead}{value}" for lead, value in secrets])
    assert all(got[i].startswith(f"x {lead}") and value not in got[i] and len(got[i]) == len(f"x {lead}{value}") for i, (lead, value) in enumerate(secrets))
