"""Open responses: their timer is set once and looked at again when it comes; pieces that come again."""

from synthtext.streaming.responses import Assembler


class State:
    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    put = update

    def appendList(self, rows):
        self.calls += 1
        self.value = self.value + rows

    def clear(self):
        self.calls += 1
        self.value = None


class Handle:
    def __init__(self):
        self.timers, self.calls, self.states = set(), 0, {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, State())

    getValueState = getListState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def piece(seq, at, done=False):
    return {"seq": seq, "text": f"<{seq}>", "finished": done, "at_ms": at}


def made():
    a, h = Assembler(100), Handle()
    a.init(h)
    return a, h, lambda *rows: [tuple(r) for r in a.handleInputRows((1, 0), iter(rows), Now(0))]


def test_few_calls_whatever_the_number_of_pieces():
    a, h, put = made()
    assert put(*[piece(k, 10) for k in range(50)]) == []
    before = h.calls + sum(s.calls for s in h.states.values())
    assert put(*[piece(k, 20) for k in range(50, 90)]) == []
    assert h.calls + sum(s.calls for s in h.states.values()) - before <= 3
    assert put(piece(90, 30, True)) == [(1, 0, "".join(f"<{k}>" for k in range(91)), 91, True)]
    assert h.timers == set() and all(s.value is None for s in h.states.values())


def test_a_timer_that_comes_early_is_set_again():
    a, h, put = made()
    put(piece(0, 10))
    put(piece(1, 60), piece(0, 50))  # piece 0 again: one entry each
    assert sorted(h.states["pieces"].value) == [(0, "<0>"), (1, "<1>")] and h.timers == {110}
    assert list(a.handleExpiredTimer((1, 0), Now(120), None)) == [] and 160 in h.timers
    assert [tuple(r) for r in a.handleExpiredTimer((1, 0), Now(161), None)] == [(1, 0, "<0><1>", 2, False)]
    assert list(a.handleExpiredTimer((1, 0), Now(200), None)) == []
