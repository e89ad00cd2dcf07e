import pytest
from pyspark.sql import functions as F

from reknit.functions import documents as d
from reknit.functions import lists, text
from reknit.functions.identifiers import qualify, quote


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(value):
    return F.lit(value) if value is not None else F.lit(None).cast("string")


@pytest.mark.parametrize("given, wanted", [
    ("0102030405", "01 02 03 04 05"), ("01.02.03.04.05", "01 02 03 04 05"), (" ", None),
    ("", None), ("123", "123"), (None, None), ("+33102030405", "+33102030405")])
def test_phone(spark, given, wanted):
    assert one(spark, text.clean_phone(lit(given))) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("Éloïse Çà ñ", "Eloise Ca n"), ("œuvre Æ ß", "oeuvre AE ss"), ("é", "e"),
    ("Łódź ø", "Lodz o"), ("plain", "plain"), (None, None), ("Nguyễn", "Nguyen")])
def test_unaccent(spark, given, wanted):
    assert one(spark, text.unaccent(lit(given))) == wanted


@pytest.mark.parametrize("first, last, wanted", [
    ("Zoé", "Du Pré (née X) (Y)", "zoedupre(y)"),
    ("Anne Marie", "Roy", "anne marieroy"),
    (None, "Roy", "roy"), ("Léa", None, "lea"), (None, None, "")])
def test_person_key(spark, first, last, wanted):
    assert one(spark, text.person_key(lit(first), lit(last))) == wanted


def test_person_key_can_strip_first_names(spark):
    key = text.person_key(F.lit("Anne Marie"), F.lit("Roy"), strip_first=True)
    assert one(spark, key) == one(spark, text.squash(F.lit("Anne Marie Roy")))


def test_first_match_only(spark):
    assert one(spark, text.replace_first(F.lit("a(b)(c)"), text.PARENTHESES)) == "a(c)"
    assert one(spark, text.replace_first(F.lit("a(b(c)d)"), text.PARENTHESES)) == "a(b"


def test_dates(spark):
    assert str(one(spark, text.iso_date(F.lit("2024/02/03")))) == "2024-02-03"
    assert one(spark, text.iso_date(F.lit("2024-13-03"), strict=False)) is None
    with pytest.raises(Exception, match="2024-13-03"):
        one(spark, text.iso_date(F.lit("2024-13-03")))


@pytest.mark.parametrize("given, wanted", [
    (None, None), ("", []), ("a", ["a"]), ("a, b", ["a", " b"]), ("a,,b,", ["a", "", "b", ""])])
def test_split_list(spark, given, wanted):
    assert one(spark, lists.split_list(lit(given))) == wanted


def test_explode_together(frame, rows):
    df = frame("id long, ids string, names string",
               (1, "1,2", "a, b,c"), (2, None, "x"), (3, "", ""), (4, "7", None))
    out = lists.explode_together(df, {"i": lists.split_list("ids"), "n": lists.split_list("names")})
    assert rows(out, "id", "i", "n") == sorted(
        [(1, "1", "a"), (1, "2", " b"), (1, None, "c"), (2, None, "x"), (4, "7", None)], key=repr)


@pytest.mark.parametrize("document, path, value, wanted", [
    ('{"b":1}', ["a"], '{"x":null}', '{"a":{"x":null},"b":1}'),
    ('{"a":{"b":1},"c":2}', ["a", "b"], '[2]', '{"a":{"b":[2]},"c":2}'),
    ('{"a":{"z":1}}', ["a", "b"], '"t"', '{"a":{"b":"t","z":1}}'),
    ('{"c":2}', ["a", "b"], "1", '{"c":2}'),
    ('{"a":5}', ["a", "b"], "1", '{"a":5}'),
    ('{"a":null}', ["a", "b"], "1", '{"a":null}'),
    ("[1]", ["a"], "1", "[1]"),
    ('{"a":{"b":{"c":1}}}', ["a", "b", "c"], "2", '{"a":{"b":{"c":2}}}'),
    (None, ["a"], "1", None),
    ('{"a":1}', ["a"], None, None),
])
def test_json_set(spark, document, path, value, wanted):
    assert one(spark, d.json_set(lit(document), path, lit(value))) == wanted


@pytest.mark.parametrize("left, right, wanted", [
    ('{"a":1,"b":2}', '{"b":3,"c":null}', '{"a":1,"b":3,"c":null}'),
    (None, '{"a":1}', None), ('{"a":1}', None, None), ("{}", '{"a":1}', '{"a":1}')])
def test_json_merge(spark, left, right, wanted):
    assert one(spark, d.json_merge(lit(left), lit(right))) == wanted


@pytest.mark.parametrize("document, wanted", [
    ('{"a":{"b":5}}', "5"), ('{"a":{"b":5.0}}', "5"), ('{"a":{"b":"5"}}', '"5"'),
    ('{"a":{"b":null}}', "null"), ('{"a":{}}', None), ("{}", None), (None, None)])
def test_json_typed(spark, document, wanted):
    assert one(spark, d.json_typed(lit(document), "a", "b")) == wanted


def test_json_text(spark):
    assert one(spark, d.json_text(F.lit('{"a":{"b":"5"}}'), "a", "b")) == "5"
    assert one(spark, d.json_text(F.lit('{"a":{"b":null}}'), "a", "b")) is None


def test_json_objects_keep_nulls(spark):
    built = d.json_nested("o", a=F.lit(1), b=F.lit(None).cast("string"))
    assert one(spark, built) == '{"o":{"a":1,"b":null}}'
    with pytest.raises(Exception, match="NULL_MAP_KEY"):
        one(spark, d.json_pair(F.lit(None).cast("long"), F.lit("x")))


@pytest.mark.parametrize("name, wanted", [
    ("Visits", ("imports", "visits")), ("S.T", ("s", "t")), ('"S".T', ("S", "t")),
    ('"a.b"', ("imports", "a.b")), ('"a""b".c', ('a"b', "c")), (" s . t ", ("s", "t"))])
def test_qualify(name, wanted):
    assert qualify(name, "imports") == wanted


@pytest.mark.parametrize("name", ["a.b.c", "", "a b", "1a", "a.", '""'])
def test_qualify_rejects(name):
    with pytest.raises(ValueError):
        qualify(name, "imports")


def test_quote():
    assert quote("a", "b`c") == "`a`.`b``c`"


def test_array_steps_in_paths(spark):
    """Elements by position, from either end; names where there is an object."""
    documents = ['{"a":[1,[2,{"x":null}],"s"],"0":{"1":5}}', "[10,20,30]", "[]", '{"a":5}', "null",
                 None, '{"a":[]}']
    df = spark.createDataFrame([(d,) for d in documents], "d string")

    def all_of(column):
        return [row[0] for row in df.select(column).collect()]

    one, seven = F.lit("1"), documents
    assert all_of(d.json_typed("d", "a", 1, 1, "x")) == ["null"] + [None] * 6
    assert all_of(d.json_text("d", "a", 1, 1, "x")) == [None] * 7
    assert all_of(d.json_typed("d", "0", "1")) == ["5"] + [None] * 6
    assert all_of(d.json_text("d", -1)) == [None, "30"] + [None] * 5
    assert all_of(d.json_text("d", -4)) == [None] * 7
    first = '{"0":{"1":5},"a":[1,[2,{"x":null}],"s"]}'
    same = [first, *seven[1:]]
    assert all_of(d.json_set("d", ["a", 1, 0], one)) == [
        '{"0":{"1":5},"a":[1,[1,{"x":null}],"s"]}', *seven[1:]]
    assert all_of(d.json_set("d", ["a", 9, "x"], one)) == same
    assert all_of(d.json_set("d", ["a", "k"], one)) == same
    assert all_of(d.json_set("d", ["a", 9], one)) == [
        '{"0":{"1":5},"a":[1,[2,{"x":null}],"s",1]}', *seven[1:6], '{"a":[1]}']
    assert all_of(d.json_set("d", ["a", -9], one))[0] == '{"0":{"1":5},"a":[1,1,[2,{"x":null}],"s"]}'
    assert all_of(d.json_set("d", [1], one))[1:3] == ["[10,1,30]", "[1]"]
    assert all_of(d.json_merge("d", F.lit("[1]"))) == [
        f"[{first},1]", "[10,20,30,1]", "[1]", '[{"a":5},1]', "[null,1]", None, '[{"a":[]},1]']
    assert all_of(d.json_merge("d", F.lit("3")))[:5] == [None, "[10,20,30,3]", "[3]", None, "[null,3]"]
