import signal

import numpy as np

from hourgrid.llm import cover_tree as ct


def test_many_vectors_of_one_direction():
    """More than a leaf of different vectors with the same unit vector: the tree ends, all link."""
    signal.signal(signal.SIGALRM, lambda *_: (_ for _ in ()).throw(TimeoutError()))
    signal.alarm(20)
    try:
        for rows in (np.ones((20, 64)) * 2.0 ** np.arange(20)[:, None], np.eye(4)[[1] * 20] * np.arange(1, 21)[:, None], np.arange(1.0, 21)[:, None]):
            x = ct.unit(np.concatenate([rows, -rows]))
            for links in (ct.Links(x, np.ones(40, dtype=int), None, None, 0.93), ct.Links(x, np.ones(40, dtype=int), x, np.ones(40, dtype=int), 0.93)):
                tree = ct.build(x)
                links.walk(tree, tree if links.own else ct.build(x))
                assert (links.count == (19 if links.own else 20)).all()
    finally:
        signal.alarm(0)
