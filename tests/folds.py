"""Plain sequential folds over pandas, to hold the parallel ones to."""

import pandas as pd

from fieldwatch.operators.ordered import ALWAYS, NEG_INF


def greedy_thin_reference(pdf: pd.DataFrame, key: str, order: list[str], t: str, theta: str,
                          e_init: int = NEG_INF) -> pd.Series:
    pdf = pdf.sort_values([key, *order], kind="stable", na_position="first")
    emit = pd.Series(False, index=pdf.index)
    last_key, e = object(), e_init
    for idx, k, tv, th in zip(pdf.index, pdf[key], pdf[t], pdf[theta]):
        if k != last_key:
            last_key, e = k, e_init
        if th == ALWAYS or tv - e >= th:
            emit[idx] = True
            e = tv
    return emit
