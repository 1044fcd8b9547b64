from mensario import fixed_values as fv
from mensario.operators.features import BOOK_GRID

LABELS = (*fv.CLASSES_PAGTO, *fv.CLASSES_VLR_PAGTO)
WINDOWS = (None, "flg_u1m", "flg_u3m", "flg_u6m", "flg_u9m", "flg_u12m")
# Offset of a value's first feature in its label's block, and features per window.
OFFSETS = {
    "fvl_vlr_fatura": (0, ("sum", "avg", "min", "max")),
    "fvl_qtd_transacao": (24, ("sum",)),
    "fvl_numero_dias_atraso": (30, ("avg", "min", "max")),
    "fvl_perc_vlr_fatura": (48, ("avg", "min", "max")),
}


def test_every_feature_has_the_number_of_the_formula():
    features = list(BOOK_GRID.features())
    assert len(features) == 462
    for feature in features:
        offset, aggs = OFFSETS[feature.value]
        label, window = LABELS.index(feature.label), WINDOWS.index(feature.flag)
        number = 66 * label + offset + len(aggs) * window + aggs.index(feature.agg) + 1
        assert feature.name == f"VAR_{number}"
    assert len({f.name for f in features}) == 462


def test_the_noted_feature():
    feature = next(f for f in BOOK_GRID.features() if f.name == "VAR_388")
    assert (feature.label, feature.flag, feature.value, feature.agg) == (
        "VALOR_PARCIAL", "flg_u6m", "fvl_perc_vlr_fatura", "avg"
    )


def test_cells_are_dense_and_shared_by_a_label_in_a_window():
    cells = {(f.label, f.flag): f.cell for f in BOOK_GRID.features()}
    assert sorted(cells.values()) == list(range(42))
