import pytest

from deltaloom.options import DEFAULT_PLACES, CaptureOptions, Format, Image, Place, parse_places, parse_tables


@pytest.mark.parametrize("text,kind", [("full", Image.FULL), (" Only-Updated ", Image.ONLY_UPDATED), ("none", Image.NONE), ("x", Image.NONE), (None, Image.NONE)])
def test_image(text, kind):
    assert Image.parse(text) is kind


def test_format_defaults_to_legacy():
    assert Format.parse(None) is Format.LEGACY and Format.parse("ADVANCED ") is Format.ADVANCED and Format.parse("?") is Format.LEGACY


def test_places():
    assert parse_places(None) == DEFAULT_PLACES
    assert parse_places("kafka-key, nothing , PAYLOAD-KEY") == {Place.KAFKA_KEY, Place.PAYLOAD_KEY}


def test_tables():
    assert parse_tables(" a.b ,c.d,a.b") == {("a", "b"), ("c", "d")}
    for bad in ("a", "a.b.c", "a.b,", "a." + "x" * 49, "a.b-c"):
        with pytest.raises(ValueError):
            parse_tables(bad)


def test_every_rule():
    ok = CaptureOptions(hosts="10.0.0.1:9042, h:1", tables="a.b")
    assert ok.errors() == [] and ok.checked() is ok
    bad = {
        "hosts": CaptureOptions(hosts="h:123456"), "tables": CaptureOptions(tables="a"), "preimages": CaptureOptions(preimages=True),
        "before": CaptureOptions(format=Format.LEGACY, before=Image.FULL), "after": CaptureOptions(format=Format.LEGACY, after=Image.ONLY_UPDATED),
        "places": CaptureOptions(format=Format.LEGACY, places=frozenset({Place.KAFKA_KEY})), "retry_attempts": CaptureOptions(retry_attempts=0),
        "heartbeat": CaptureOptions(heartbeat=0), "user": CaptureOptions(user="a"),
    }
    for start, o in bad.items():
        assert [e for e in o.errors() if e.startswith(start)], start
        with pytest.raises(ValueError):
            o.checked()
    assert CaptureOptions.from_config({"cdc.output.format": "advanced", "cdc.include.primary-key.placement": "kafka-key,foo"}).errors() == ["places: unknown foo"]


def test_from_config():
    o = CaptureOptions.from_config({
        "topic.prefix": "p", "table.names": "a.b", "cdc.output.format": "advanced", "cdc.include.before": "full", "cdc.include.after": "only-updated",
        "cdc.include.primary-key.placement": "payload-key", "query.time.window.size": "5", "experimental.preimages.enabled": "false", "ssl.enabled": "true"})
    assert (o.before, o.after, o.query_window, o.preimages) == (Image.FULL, Image.ONLY_UPDATED, 5, False)
    assert o.places == {Place.PAYLOAD_KEY} and o.source_options == {"ssl.enabled": "true"} and o.needs_pre and o.needs_post


def test_names_of_settings():
    text = {"worker.max.retries": "3", "worker.maximum.backoff": "70", "worker.jitter.percentage": "5", "worker.retry.backoff.base": "9", "initial.lookback.ms": "11",
            "minimal.wait.for.window.time": "13", "worker.shared.session.enabled": "true", "worker.pooling.max.queue.size": "8", "user": "u", "password": "p"}
    for prefix in ("", "vendor."):
        o = CaptureOptions.from_config({prefix + k: v for k, v in text.items()}, prefix)
        assert (o.retry_attempts, o.retry_cap, o.retry_jitter, o.retry_base, o.lookback, o.minimal_wait, o.user) == (3, 70, 5, 9, 11, 13, "u")
        assert o.source_options == {"worker.shared.session.enabled": "true", "worker.pooling.max.queue.size": "8"} and o.errors() == []
    assert CaptureOptions.from_config({"worker.retry.attempts": "3"}).errors() == ["worker.retry.attempts: no such setting"]
