"""Random boxes and plain loops that say what the operators should give."""
import random

MODELS = ["eva-02-01", "co_detr", "eva-02-02", "ov_sam", "owl_vit", "pomp", "grit"]


def random_boxes(seed, images=3, per_image=60, spread=60, labels=4):
    """Rows image_id, model, priority, seq, x1..y2, score, label, with near and exact copies."""
    r = random.Random(seed)
    rows = []
    for image in range(images):
        count = {}
        last = None
        for _ in range(per_image):
            m = r.randrange(7)
            if last and r.random() < 0.3:
                x, y, w, h = last
            elif last and r.random() < 0.3:
                x, y, w, h = last[0] + r.randrange(3), last[1] + r.randrange(3), last[2] + r.randrange(3), last[3]
            else:
                x, y, w, h = r.randrange(spread), r.randrange(spread), r.choice([0, 5, 20, 40, 41]), r.choice([3, 20, 40])
            last = (x, y, w, h)
            s = count[m] = count.get(m, 0) + 1
            rows.append((image, MODELS[m], m + 1, s, float(x), float(y), float(x + w), float(y + h), r.randrange(1, 100) / 100,
                         "person" if r.random() < 0.2 else f"c{r.randrange(labels)}"))
    return rows


SCHEMA = "image_id long, model string, priority int, seq int, x1 double, y1 double, x2 double, y2 double, score double, label string"


def inter(a, b, u=0):
    return max(0, min(a[2], b[2]) - max(a[0], b[0]) + u) * max(0, min(a[3], b[3]) - max(a[1], b[1]) + u)


def area(a, u=0):
    return (a[2] - a[0] + u) * (a[3] - a[1] + u)


def iou(a, b, u=0, floor=None):
    un = area(a, u) + area(b, u) - inter(a, b, u)
    if floor:
        un = max(un, floor)
    return inter(a, b, u) / un if un > 0 else 0.0


def box(r):
    return r[4:8]


def greedy(rows, related):
    """Leaders and the leader of every row, rows given in order."""
    lead, owner = [], {}
    for r in rows:
        k = next((k for k in lead if related(k, r)), None)
        if k is None:
            lead.append(r)
        owner[r] = k or r
    return lead, owner


def groups(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out
