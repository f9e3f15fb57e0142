from pickwise.functions.columns import (above, cooccurrence_sim, epoch_seconds,
                                        log10_count, year_month)

__all__ = ["above", "cooccurrence_sim", "epoch_seconds", "log10_count", "year_month"]
