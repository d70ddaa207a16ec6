"""Threat scores from the store and an intelligence table."""

from firelog.operators.threat import threat_score


def test_threat_score(spark):
    store = spark.createDataFrame(
        [("10.0.0.1", "INTRUSION-DETECTED")] * 30 + [("10.0.0.2", "PORTSCAN")] + [("10.0.0.3", "OTHER"), ("10.0.0.3", None)],
        "source_ip string, reason string")
    feed = spark.createDataFrame([("10.0.0.1", 90), ("10.0.0.1", 5), ("10.0.0.2", None), (None, 50), ("10.9.9.9", 9)],
                                 "ip_address string, weight long")
    got = {r.source_ip: (r.events, r.listed, r.threat_score, r.malicious) for r in threat_score(store, feed).collect()}
    assert got == {"10.0.0.1": (30, True, 100, True), "10.0.0.2": (1, True, 26, False), "10.0.0.3": (2, False, 2, False)}
    assert threat_score(store.limit(0), feed).count() == 0
