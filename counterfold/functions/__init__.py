from counterfold.functions.scalar import (
    clip,
    expit,
    logit,
    lossless_cast,
    quoted,
    two_sided_p,
)

__all__ = ["clip", "expit", "logit", "lossless_cast", "quoted", "two_sided_p"]
