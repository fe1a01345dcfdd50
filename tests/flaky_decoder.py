"""A decoder that fails the first time it reads the first strip (retry test)."""

import os

from rastercube.sources.tiles import NPY_DECODER


def _rows(zf, member, r0, r1):
    mark = os.environ.get("RASTERCUBE_FLAKY_MARK")
    if mark and r0 == 0 and not os.path.exists(mark):
        open(mark, "w").close()
        raise IOError("simulated loss of the task")
    return NPY_DECODER[1](zf, member, r0, r1)


FLAKY = (".npy", _rows, NPY_DECODER[2])
