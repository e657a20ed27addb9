"""Table operators, each ``f(df, ..., params) -> DataFrame``.

bars          B1-B8 (quote bars, incremental cutoff, daily consolidation, medians)
dedupe        D1-D4 and the W2/W3/W6 merge plans (first/last per key by aggregate)
windows       N1-N5, K1-K3 (lag, chunked lag for hot keys, forward fill, top-N)
sets          U1-U2 (table counts, quality counts)
calendar      G1-G8, U3-U4 (trading days, sessions, gaps, grids, normalisation)
rolls         L1-L2
instruments   B9-B18 (dimensions, metadata, definitions)
coverage      C1-C33
checks        V1-V12
index_quality I1-I7
curves        X1-X6
sessions      P17-P18, universe P10, normalize P1/P15/P19/P20, lookup P21
"""
