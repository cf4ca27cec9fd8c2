import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.functions import jsontext

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=20)


@settings(max_examples=200, deadline=None)
@given(VALUES)
def test_both_scanners_read_and_write_alike(value):
    for text in (json.dumps(value), json.dumps(value, indent=2, ensure_ascii=False)):
        a, b = jsontext.read(text, strict=True), jsontext._read_deep(text, True)
        assert a == b and json.loads(jsontext.write(a)) == json.loads(jsontext.write(b, ascii_only=True)) == value


@pytest.mark.parametrize("text", ["", "[", "{", "[1,]", '{"a"}', '{"a":}', "{,}", "[1 2]", "1 2", '{"a":1,}', "}", "[}", '{"a":1]', "nul", "[01]", '"a', '{"a":1,"a":2}', ",", ":", "NaN", "[Infinity]", '"\n"', "[,1]", "{1:2}"])
def test_what_is_no_json(text):
    for scan in (lambda: jsontext.read(text, strict=True), lambda: jsontext._read_deep(text, True)):
        with pytest.raises(ValueError):
            scan()


def test_numbers_and_depth():
    assert jsontext.write(jsontext.read("[1.10, 1E5, -0, 12345678901234567890123456789012345678901234567890.0]")) == "[1.10,1E5,-0,12345678901234567890123456789012345678901234567890.0]"
    deep = '{"a":[' * 50_000 + "1.50" + "]}" * 50_000
    assert jsontext.write(jsontext.read(deep)) == deep
    assert jsontext.read('{"a":1,"a":2}') == {"a": "2"}
    assert [jsontext.plain(v) for v in jsontext.read('[null,true,2.50,"x",{"a":[1]}]')] == [None, "true", "2.50", "x", '{"a":[1]}']
