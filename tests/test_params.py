import pytest

from tickloom.functions import params as P


def test_intervals():
    assert P.interval_span() == "1 hour" and P.interval_span("15m") == "15 minutes"
    with pytest.raises(ValueError):
        P.interval_span("4h")


def test_limits():
    assert P.check_limit() == 100 and P.check_limit("1000") == 1000 and P.check_limit(None, 200) == 200
    for bad in (0, 1001, "x", -5):
        with pytest.raises(ValueError):
            P.check_limit(bad)


@pytest.mark.parametrize("value,sma,ema,rsi", [(None, 20, 12, 14), ("x", 20, 12, 14), (0, 20, 12, 14), (1, 2, 2, 2), (150, 150, 150, 100), (999, 200, 200, 100)])
def test_periods(value, sma, ema, rsi):
    assert (P.sma_period(value), P.ema_period(value), P.rsi_period(value)) == (sma, ema, rsi)


def test_lookback():
    assert P.lookback_bars(30, "1h") == 720
    assert P.lookback_bars(1, "1m") == 1000
    assert P.lookback_bars(2, "5m") == 576 and P.lookback_bars(2, "15m") == 576


def test_symbols():
    assert P.check_symbol("BTCUSDT") == "BTCUSDT"
    for bad in ("btc", "B", "", "A" * 21, "BTC-USD"):
        with pytest.raises(ValueError):
            P.check_symbol(bad)


def test_horizon():
    assert P.horizon_minutes() == 60 and P.horizon_minutes("1") == 1 and P.horizon_minutes(1440) == 1440
    for bad in (0, 1441, "x", -1):
        with pytest.raises(ValueError):
            P.horizon_minutes(bad)
