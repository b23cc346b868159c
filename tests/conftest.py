from __future__ import annotations

import pytest

from netforensics.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, name="netforensics-tests")
    yield session
    session.stop()


CONN = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, dst_port int, proto string, orig_bytes bigint, "
    "resp_bytes bigint, history string, http_method string, http_host string, http_uri string, ftp_upload_cmd string"
)


@pytest.fixture
def conns(spark):
    def build(rows):
        out = []
        for i, r in enumerate(rows):
            base = dict(
                case_id="c1", seq=i, ts=1000.0, src_ip="10.0.0.5", dst_ip="203.0.113.50", dst_port=443, proto="tcp",
                orig_bytes=100, resp_bytes=5000, history="", http_method=None, http_host=None, http_uri=None,
                ftp_upload_cmd=None,
            )
            base.update(r)
            out.append(base)
        return spark.createDataFrame(out, CONN)

    return build
