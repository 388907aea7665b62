from shelfwise.plans.layers import bronze, gold, signal_history, signals, silver

__all__ = ["bronze", "gold", "signal_history", "signals", "silver"]
