import pytest
from pyspark.sql import functions as F

from strataloom.functions import masks, text
from strataloom.plans import privacy as p


def _one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn("v")).first()[0]


@pytest.mark.parametrize("value, shown", [("ann@x.ee", "a***@x.ee"), ("@x.ee", "***"), ("none", "***"), (None, "***")])
def test_email(spark, value, shown):
    assert _one(spark, value, masks.mask_email) == shown


@pytest.mark.parametrize("value, shown", [("Juhan", "J****"), ("J", "J"), ("", ""), (None, None)])
def test_text(spark, value, shown):
    assert _one(spark, value, masks.mask_text) == shown


def test_phone_and_int(spark):
    assert _one(spark, "+37255512345", masks.mask_phone) == "+372 *** 45"
    assert spark.range(1).select(masks.mask_int(F.lit(12345)), masks.mask_int(F.lit(-1))).first()[:] == (12000, -1000)


@pytest.mark.parametrize("value, shown", [("MARY-ann o'neil", "Mary-Ann O'Neil"), ("õun  ÄÄR", "Õun  Äär"), ("", ""), (None, None)])
def test_capitalize(spark, value, shown):
    assert _one(spark, value, text.capitalize_words) == shown


@pytest.mark.parametrize("value, rest", [("Mari Ann Kask", "Ann Kask"), ("Mari", ""), (None, None)])
def test_rest_of_name(spark, value, rest):
    assert _one(spark, value, text.after_first_word) == rest


POLICY = {"name": {"auditor": "keep", "analyst": "text", "other": "null"}, "mail": {"auditor": "keep", "other": "redacted"}}


@pytest.mark.parametrize(
    "roles, seen",
    [(["analyst", "auditor"], ("Ann", "a@x")), (["analyst"], ("A**", "REDACTED")), (["marketing"], (None, "REDACTED")), ([], (None, "REDACTED")), (["guest"], (None, "REDACTED"))],
)
def test_strongest_role_decides(spark, roles, seen):
    df = spark.createDataFrame([("Ann", "a@x")], "name string, mail string")
    view = p.secure_view(df, POLICY, roles)
    assert tuple(view.first()) == seen
    assert view.dtypes == df.dtypes


def test_a_column_without_policy_is_refused(spark):
    df = spark.createDataFrame([("Ann", "a@x", "123")], "name string, mail string, ssn string")
    with pytest.raises(ValueError, match="ssn"):
        p.secure_view(df, POLICY, ["auditor"])
    assert tuple(p.secure_view(df, POLICY, [], keep=["ssn"]).first()) == (None, "REDACTED", "123")


def test_region(spark):
    df = spark.createDataFrame([("EE", "x"), ("FI", "y"), (None, "z")], "country string, mail string")
    assert p.region_rows(df, "country", "EE").count() == 1
    assert p.region_rows(df, "country", None).count() == 0
    with pytest.raises(PermissionError, match="mail"):
        p.regional_view(df, "country", "EE", ["country"], ["country", "mail"])
    assert p.regional_view(df, "country", "EE", ["country"]).columns == ["country"]


def test_small_groups(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "g string")
    assert [tuple(r) for r in p.small_groups(df, ["g"]).collect()] == [("b", 2)]
    assert {tuple(r) for r in p.suppressed_counts(df, ["g"]).collect()} == {("a", 3), ("b", None)}


def test_unregistered_column_is_left_out(spark):
    df = spark.createDataFrame([("Ann", 1, "secret")], "name string, n int, note string")
    got = p.mask_by_register(df, {"name": "direct", "n": "none"}, {"direct": "null"})
    assert got.columns == ["name", "n"] and tuple(got.first()) == (None, 1)


def test_privilege_matrix(spark):
    grants = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "role_name string, object_name string")
    got = {tuple(r) for r in p.privilege_matrix(grants).select("role_name", "object_name", "can_select").collect()}
    assert got == {("a", "x", True), ("a", "y", False), ("b", "x", False), ("b", "y", True)}


def test_audit_lines(spark):
    lines = [
        'db | AUDIT: SESSION,1,1,READ,SELECT,VIEW,secured.v,"SELECT first, email, ""Email"" FROM v",<none>',
        "db | AUDIT: SESSION,2,1,READ,SELECT,TABLE,marts.d,SELECT emailed,<none>",
        "db | AUDIT: SESSION,3,1,ROLE,GRANT,,,GRANT SELECT,<none>",
        "db | checkpoint starting",
    ]
    audit = p.parse_audit(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert audit.count() == 3
    first = audit.where("statement_id = 1").first()
    assert first.statement == 'SELECT first, email, "Email" FROM v' and first.parameter == "<none>"
    assert {tuple(r) for r in p.reads_per_object(audit).collect()} == {("secured.v", 1, 1), ("marts.d", 1, 0)}
