"""A misspelt import in this subpackage must not drop its queries unnoticed."""

import pytest

pytest.importorskip("public_tokenizers")


def test_all_operators_are_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert [sum(name.startswith(f"op{n}_") for name in found) for n in range(1, 14)] == [1] * 13 and "pipeline" in found
