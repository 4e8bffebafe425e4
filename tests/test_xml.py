"""XML at plain paths (SEMI-06 to SEMI-09): read by from_xml, with the results of Spark's XPath on any document."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import semi as M

DOCS = [None, "<a/>", '<a id="1" s="x &amp; y"><b>t<i>u</i>v</b><b n="2">w</b></a>', '<z id="1"><b>t</b></z>', "<a id=''><b></b><c><b>k</b></c></a>",
        '<a xmlns="urn:x" id="3"><b>n</b></a>', '<a p:id="4" id="5"><p:b>m</p:b><b>o</b></a>', "<a><b>x<!-- c -->y</b><b><![CDATA[<q>]]></b></a>",
        '<?xml version="1.0"?><a id="6"><b>12:30</b></a>', '<a id="a\tb"><b> p </b>\n<b>q</b></a>',
        '<a id="7"><c/><c><b n=""/><b n="8">r</b></c><b/><b>s</b></a>', '<a><B n="1">t</B><b> </b></a>', '<a id="1"> <b>u</b> <b n="3">  v w</b> </a>',
        '<a ID="9"><c><b n=" x ">1</b></c></a>', '<a><b>1</b><c>2</c><b>3<i n="4">5</i></b></a>']


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "n int, xml string")


@pytest.mark.parametrize("path", ["/a", "/a/b", "/a/b[2]", "/a/c/b", "/a/c[1]/b[1]", "/a/b[2]/i", "/a/b/i", "//b", "/a/*"])
def test_text_and_attributes_are_those_of_xpath(docs, path):
    got = docs.select("n", M.xml_text("xml", path), M.xml_attr("xml", path, "id"), M.xml_attr("xml", path, "n"))
    want = docs.select("n", F.xpath_string("xml", F.lit(path)), F.xpath_string("xml", F.lit(f"{path}/@id")),
                       F.xpath_string("xml", F.lit(f"{path}/@n")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_documents_that_are_no_xml_fail(spark):
    bad = spark.createDataFrame([("<a><b></a>",)], "xml string")
    with pytest.raises(Exception, match="MALFORMED|Invalid XML|end-tag"):
        bad.select(M.xml_text("xml", "/a/b")).collect()


def test_plain_paths_do_not_set_up_a_parser_for_every_row(docs):
    plan = docs.select(M.xml_attr("xml", "/a", "id"))._jdf.queryExecution().executedPlan().toString()
    assert "from_xml" in plan.lower() and "xpath" in plan.lower()
