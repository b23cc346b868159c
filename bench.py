"""Wall seconds of the headline queries, printed as one JSON line.

BENCH_SF_DIR names the table directory, BENCH_CPUS the local cores. Each query runs once on the
smallest sibling directory to warm up (class loading, code generation) and once measured on the
whole tables; its whole result is written to the no-op sink. BENCH_QUERIES takes a comma list or
"all" for every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from netforensics.adapters.queries import REGISTRY
from netforensics.session import local_session


HEADLINE = [
    "beaconing", "exfil_volume", "ftp_store_exfil", "unclassified_egress", "to_connections", "dns_tunnel", "dga_burst",
    "resolved_destinations", "cloud_exfil", "smtp_exfil", "http_gate", "icmp_tunnel", "port_mismatch",
    "tls_certificate", "ja3_hash", "ja4_hash", "flow_assembly", "intel_lookup", "domain_reputation",
    "suffix_allowlist", "geo_range", "corroboration_tier", "correlate_best", "clock_sync", "static_prior_match",
    "provenance", "timeline", "family", "hash_chain", "chain_verify", "ioc_export", "contract_violations",
    "precision_recall", "dga_score", "zeek_conn", "outbound_content", "evidence_hashes", "stix_bundles", "network_findings",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(REGISTRY) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, name="netforensics-bench")
    spark.sparkContext.setLogLevel("OFF")
    sibling = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = sibling if os.path.isdir(sibling) else sf_dir
    seconds = {}
    for name in names:
        run(spark, name, warm_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of the measured queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
