"""Instruments' XML: dialects, condensing, and files with many elements."""

import io
import resource

from metaloom.sources import tracings as T

FILES = {
    "mbf.xml": '<mbf xmlns="http://www.mbfbioscience.com/2007/neurolucida" appname="a" appversion="1"><sparcdata><subject subjectid="s1" sex="F"/><atlas/></sparcdata><contour name="c"><property name="GUID"><s>1</s></property></contour><contour name="c"><property name="GUID"><s>2</s></property></contour><contour/><tree type="t" leaf="l"/><vessel type="v"><property name="Channel"><s>1</s><s>2</s></property></vessel><images><image/></images></mbf>',
    "other.xml": '<mbf xmlns="http://x"/>', "zen.xml": "<CellCounter_Marker_File><Image_Properties><Image_Filename>a.czi</Image_Filename></Image_Properties></CellCounter_Marker_File>",
    "las.xml": '<Data><ImageDescription><FileLocation>D:\\x</FileLocation></ImageDescription><Image><Attachment Application="LAS AF"/></Image></Data>', "notlas.xml": "<Data><ImageDescription><FileLocation>x</FileLocation></ImageDescription></Data>",
    "hs.xml": '<SampleTable><SampleTableHeader HyStarVersion="4"/></SampleTable>', "hm.xml": '<method><submethods><submethod program="HyStar_LC"/></submethods></method>', "nohm.xml": '<method><submethods><submethod program="x"/></submethods></method>',
    "k.xml": '<Store Type="Keyence.A"/>', "nok.xml": '<Store Type="A"/>', "pv.xml": "<PVScan/>", "bad.xml": '<mbf><contour name="x"/>', "intan.xml": '<IntanRHX><GeneralConfig a="1"/><SignalGroup Name="A"><Channel b="2"/></SignalGroup></IntanRHX>',
}


def test_dialects_and_condensed_items(spark):
    rows = T.items(spark.createDataFrame([*((p, bytearray(t.encode())) for p, t in FILES.items()), ("null.xml", None), ("empty.xml", bytearray())], "path string, content binary"))
    dialects = {r.file: r.dialect for r in rows.filter("section IS NULL AND error IS NULL").collect()}
    assert dialects == {"mbf.xml": "mbf", "other.xml": "generic", "zen.xml": "zen", "las.xml": "las", "notlas.xml": "generic", "hs.xml": "hystar-sample", "hm.xml": "hystar-submethods", "nohm.xml": "generic", "k.xml": "keyence", "nok.xml": "generic", "pv.xml": "pvscan", "intan.xml": "intan"}
    assert {r.file for r in rows.filter("error IS NOT NULL").collect()} == {"bad.xml", "empty.xml"}
    told = {}
    for r in T.condensed(rows).collect():
        told.setdefault(r.file, []).append((r.section, r.item))
    assert sorted(told.pop("mbf.xml")) == sorted([
        ("meta", '{"appname":"a","appversion":"1"}'), ("subject", '{"id":"s1","sex":"F"}'), ("contours", '{"name":"c"}'), ("contours", "{}"), ("trees", '{"entity_type":"t","leaf":"l"}'), ("vessels", '{"channel":["1","2"],"entity_type":"v"}'), ("images", '{"path_mbf":[]}'),
    ])
    assert told == {"zen.xml": [("images", '{"path_zen":["a.czi"]}')], "las.xml": [("images", '{"path_las":["D:\\\\x"]}')], "intan.xml": told["intan.xml"]}
    assert sorted(told["intan.xml"]) == [("Channel", '{"b":"2"}'), ("GeneralConfig", '{"a":"1"}'), ("SignalGroup", '{"Name":"A"}')]


def test_elements_are_let_go():
    out = io.BytesIO()
    out.write(b"<mbf>")
    for _ in range(20):
        out.write(b'<tree type="t">' + b'<point x="1" y="2" z="3" d="4"/>' * 20_000 + b"</tree>")
    out.write(b"</mbf>")
    content = out.getvalue()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert sum(1 for _ in T._pulled(content)) == 22
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60_000
