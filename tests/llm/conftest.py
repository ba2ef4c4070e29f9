import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
