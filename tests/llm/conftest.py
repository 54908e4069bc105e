import os

SMALL = "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    import pytest
    if not os.path.isdir(SMALL):
        for item in items:
            if "given" in item.name:
                item.add_marker(pytest.mark.skip(reason="no test data"))
