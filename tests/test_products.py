import pytest

from coverlake.operators.premium import of_products

POLICIES = [(1, "A"), (2, "B"), (3, "C"), (4, None), (5, "unknown"), (5, "unknown")]


@pytest.mark.parametrize("line, excluded, want", [
    (None, (), [1, 2, 3, 4, 5, 5]),
    (None, ("B", "C"), [1, 4, 5, 5]),
    ("x", (), [1, 2]),
    ("x", ("B",), [1]),
    ("none", (), []),
])
def test_line_and_excluded_products(rows, line, excluded, want):
    policy = rows("policy_id long, product_code string", POLICIES)
    product = rows("product_code string, business_line string", [("A", "x"), ("B", "x"), ("C", "y"), ("D", None)])
    got = of_products(policy, product, line, excluded)
    assert sorted(got.columns) == sorted(policy.columns) and sorted(r.policy_id for r in got.collect()) == want


def test_a_line_without_the_product_table(rows):
    with pytest.raises(ValueError):
        of_products(rows("policy_id long, product_code string", POLICIES), line="x")
