import pytest

from cinder.sources.tables import TABLE_NAMES, TABLE_SCHEMAS, read_table

DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"]


@pytest.mark.parametrize("sf_dir", DIRS)
def test_declared_schemas_match_files(spark, sf_dir):
    assert set(TABLE_SCHEMAS) == set(TABLE_NAMES)
    for t in TABLE_NAMES:
        declared = [(f.name, f.dataType.simpleString()) for f in read_table(spark, sf_dir, t).schema]
        inferred = [(f.name, f.dataType.simpleString()) for f in read_table(spark, sf_dir, t, infer=True).schema]
        assert declared == inferred, t
