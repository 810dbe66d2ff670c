"""Plain Python model of span tagging and decoding, written from the rules alone."""

from __future__ import annotations


def tag(tokens, entities):
    """Tag (entity tokens, label) pairs in order, each at its first free place."""
    tags = ["O"] * len(tokens)
    low = [token.lower() for token in tokens]
    for entity, label in entities:
        size = len(entity)
        if not size:
            continue
        free = [i for i in range(len(low) - size + 1) if set(tags[i:i + size]) == {"O"}]
        same = {i: sum(a == b.lower() for a, b in zip(low[i:i + size], entity)) for i in free}
        places = [i for i in free if same[i] == size]
        if not places and size > 2:
            places = [i for i in free if same[i] / size >= 0.8]
        if places:
            inner = ["S"] if size == 1 else ["B", *"I" * (size - 2), "E"]
            tags[places[0]:places[0] + size] = [f"{prefix}-{label}" for prefix in inner]
    return tags


def decode(tokens, tags):
    found = {"Brand": [], "Attribute": [], "ProductType": []}
    words, label = None, None
    for token, full in zip(tokens, tags):
        prefix, _, name = full.partition("-")
        if prefix == "S":
            found[name].append(token)
        elif prefix == "B":
            words, label = [token], name
        elif prefix in ("I", "E") and words:
            words.append(token)
            if prefix == "E":
                found[label].append(" ".join(words))
                words = None
        else:
            words = None
    return found
