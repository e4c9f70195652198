"""Pixel arithmetic on stacks of equally large pictures, ``uint8[n, height, width, channel]`` in RGB.

Small helpers for the Arrow jobs in ``operators/images.py``: each works on all pictures of a slice
at once.
"""

from __future__ import annotations

import numpy as np

# fixed values: statistics of the ImageNet training set, R G B
IMAGENET_MEAN = (0.485, 0.456, 0.406)
IMAGENET_STD = (0.229, 0.224, 0.225)

# fixed values: corner points (position, level) of the "jet" colour scale
JET_RED = ((0.0, 0.35, 0.66, 0.89, 1.0), (0.0, 0.0, 1.0, 1.0, 0.5))
JET_GREEN = ((0.0, 0.125, 0.375, 0.64, 0.91, 1.0), (0.0, 0.0, 1.0, 1.0, 0.0, 0.0))
JET_BLUE = ((0.0, 0.11, 0.34, 0.65, 1.0), (0.5, 1.0, 1.0, 0.0, 0.0))

# fixed values: luma weights of R G B in 1/65536
LUMA = (19595, 38470, 7471)


def truncate(values: np.ndarray) -> np.ndarray:
    return np.clip(values, 0, 255).astype(np.uint8)


def to_rgb(stack: np.ndarray) -> np.ndarray:
    return np.repeat(stack, 3, axis=3) if stack.shape[3] == 1 else stack[..., :3]


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(1 - np.abs(x), 0.0)


RUN = 16
FILTERS = {"lanczos": (_lanczos, 3.0), "bilinear": (_triangle, 1.0)}


def _weight_blocks(old, size, window, method):
    """Dense weights for runs of neighbouring outputs: (outputs, inputs, matrix)."""
    shape, radius = FILTERS[method]
    scale = old / size
    stretch = max(scale, 1.0)
    for start in range(*window, RUN):
        out = np.arange(start, min(start + RUN, window[1]))
        centre = (out + 0.5) * scale
        first = np.maximum((centre - radius * stretch + 0.5).astype(int), 0)
        last = np.minimum((centre + radius * stretch + 0.5).astype(int), old)
        into = np.arange(first[0], last[-1])
        used = (into >= first[:, None]) & (into < last[:, None])
        weights = np.where(used, shape((into + 0.5 - centre[:, None]) / stretch), 0.0)
        weights /= weights.sum(axis=1, keepdims=True)
        yield slice(out[0], out[-1] + 1), slice(into[0], into[-1] + 1), weights


def _levels(values):
    """Nearest whole level; exact halves go up, whatever order the sum was taken in."""
    return np.clip(np.floor(values + (0.5 + 1e-9), out=values), 0, 255, out=values)


def resize(stack, height, width, method="bilinear", rows=None, columns=None):
    """Resize; ``rows`` and ``columns`` say which part of the result is wanted.

    First along the rows, then along the columns, rounded after each as 8-bit pictures are.
    """
    n, old_height, old_width, channels = stack.shape
    rows, columns = rows or (0, height), columns or (0, width)
    lines = stack.transpose(0, 1, 3, 2).reshape(-1, old_width)
    if old_width == width:
        lines = lines[:, slice(*columns)].astype(np.float64)
    else:
        source, lines = lines.astype(np.float64), np.empty((len(lines), columns[1] - columns[0]))
        for out, into, weights in _weight_blocks(old_width, width, columns, method):
            at = slice(out.start - columns[0], out.stop - columns[0])
            lines[:, at] = source[:, into] @ weights.T
        lines = _levels(lines)
    lines = lines.reshape(n, old_height, -1)
    if old_height == height:
        done = lines[:, slice(*rows)]
    else:
        done = np.empty((n, rows[1] - rows[0], lines.shape[2]))
        for out, into, weights in _weight_blocks(old_height, height, rows, method):
            done[:, out.start - rows[0] : out.stop - rows[0]] = weights @ lines[:, into]
        done = _levels(done)
    picture = done.astype(np.uint8).reshape(n, rows[1] - rows[0], channels, -1)
    return np.ascontiguousarray(picture.transpose(0, 1, 3, 2))


def resize_nearest(stack, height, width):
    rows = ((np.arange(height) + 0.5) * stack.shape[1] / height).astype(int)
    columns = ((np.arange(width) + 0.5) * stack.shape[2] / width).astype(int)
    return stack[:, rows][:, :, columns]


def centre_crop(stack, size):
    _, height, width, _ = stack.shape
    ratio = max(size / width, size / height)
    width, height = (max(int(side * ratio + 0.5), size) for side in (width, height))
    left, top = (width - size) // 2, (height - size) // 2
    return resize(stack, height, width, "lanczos", (top, top + size), (left, left + size))


def random_crop(stack, size, draws):
    """Stretch to a square of ``size / scale`` with scale in 0.8 .. 1, then cut a random window."""
    out = []
    for picture, (scale, left, top) in zip(stack, draws):
        side = int(size / (0.8 + 0.2 * scale))
        left, top = int(left * (side - size + 1)), int(top * (side - size + 1))
        out.append(
            resize(picture[None], side, side, "lanczos", (top, top + size), (left, left + size))
        )
    return np.concatenate(out)


def _histograms(stack):
    """Counts per level of each picture and channel."""
    return np.array(
        [[np.bincount(p[..., c].ravel(), minlength=256) for c in range(p.shape[2])] for p in stack]
    )


def _look_up(stack, tables):
    """Replace each level by its entry in the table of its picture and channel."""
    out = np.empty_like(stack)
    for i, picture in enumerate(stack):
        for c in range(picture.shape[2]):
            out[i, ..., c] = tables[i, c].take(picture[..., c])
    return out


def autocontrast(stack, cutoff):
    """Stretch each channel after dropping ``cutoff`` percent of its pixels at either end."""
    counts = _histograms(stack)
    cut = stack.shape[1] * stack.shape[2] * cutoff // 100
    low = (counts.cumsum(-1) > cut).argmax(-1)[..., None]
    high = 255 - (counts[..., ::-1].cumsum(-1) > cut).argmax(-1)[..., None]
    scale = 255.0 / np.maximum(high - low, 1)
    levels = np.arange(256)
    table = np.where(high > low, truncate(levels * scale + -low * scale), levels)
    return _look_up(stack, table.astype(np.uint8))


def equalize(stack):
    """Histogram equalisation per channel; the brightest level does not count for the step."""
    counts = _histograms(stack)
    brightest = 255 - (counts[..., ::-1] > 0).argmax(-1)[..., None]
    rest = counts.sum(-1, keepdims=True) - np.take_along_axis(counts, brightest, -1)
    step = rest // 255
    below = counts.cumsum(-1) - counts
    table = np.where(step > 0, (step // 2 + below) // np.maximum(step, 1), np.arange(256))
    return _look_up(stack, np.minimum(table, 255).astype(np.uint8))


def _middle(a, b, c):
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def median3(stack):
    """Median of the 3 x 3 neighbourhood, with the border repeated.

    Sorted columns are shared by neighbouring windows: the median is the middle of the largest
    minimum, the middle of the middles and the smallest maximum.
    """
    wide = np.pad(stack, ((0, 0), (1, 1), (1, 1), (0, 0)), mode="edge")
    up, mid, down = wide[:, :-2], wide[:, 1:-1], wide[:, 2:]
    low = np.minimum(np.minimum(up, mid), down)
    high = np.maximum(np.maximum(up, mid), down)
    centre = _middle(up, mid, down)

    def columns(a):
        return a[:, :, :-2], a[:, :, 1:-1], a[:, :, 2:]

    lows, highs = columns(low), columns(high)
    return _middle(
        np.maximum(np.maximum(lows[0], lows[1]), lows[2]),
        _middle(*columns(centre)),
        np.minimum(np.minimum(highs[0], highs[1]), highs[2]),
    )


def luma(stack):
    """Grey level of each pixel."""
    red, green, blue = (stack[..., i].astype(np.int32) * w for i, w in enumerate(LUMA))
    return (red + green + blue + 32768) >> 16


def _by_channel(stack, change):
    """Work on one channel of the whole stack at a time: long runs of equal work."""
    out = np.empty(stack.shape, np.uint8)
    for c in range(stack.shape[3]):
        out[..., c] = truncate(change(stack[..., c], c))
    return out


def saturation(stack, factor):
    grey = luma(stack).astype(np.float32)
    return _by_channel(stack, lambda plane, c: grey + np.float32(factor) * (plane - grey))


def white_balance(stack):
    """Grey-world balance; a black channel stays black."""
    means = stack.mean(axis=(1, 2), dtype=np.float64)
    target = means.sum(1, keepdims=True) / means.shape[1]
    factor = np.where(means > 0, target / np.where(means > 0, means, 1), 1.0)
    return _by_channel(stack, lambda plane, c: plane * factor[:, c, None, None])


def colour_norm(stack, mean=IMAGENET_MEAN, std=IMAGENET_STD):
    """Normalise and undo it again, which only truncates."""
    mean, std = np.array(mean), np.array(std)

    def change(plane, c):
        unit = plane.astype(np.float32) / np.float32(255)
        return ((unit - mean[c]) / std[c] * std[c] + mean[c]) * 255

    return _by_channel(stack, change)


def mirror(stack, chosen):
    return np.where(chosen[:, None, None, None], stack[:, :, ::-1], stack)


def brightness(stack, factors):
    return truncate(stack * factors.astype(np.float32)[:, None, None, None])


def rotate(stack, degrees):
    """Turn each picture about its centre, bilinear, black outside."""
    _, height, width, channels = stack.shape
    x = np.arange(width) + 0.5 - width / 2
    y = (np.arange(height) + 0.5 - height / 2)[:, None]
    out = np.empty_like(stack)
    for i, angle in enumerate(np.radians(degrees)):
        cos, sin = np.cos(angle), np.sin(angle)
        from_x, from_y = cos * x - sin * y + width / 2, sin * x + cos * y + height / 2
        outside = (from_x < 0) | (from_x >= width) | (from_y < 0) | (from_y >= height)
        from_x, from_y = from_x - 0.5, from_y - 0.5
        left, top = np.floor(from_x), np.floor(from_y)
        dx, dy = from_x - left, from_y - top
        left, top = left.astype(np.int32), top.astype(np.int32)
        x0, x1 = np.clip(left, 0, width - 1), np.clip(left + 1, 0, width - 1)
        y0, y1 = np.clip(top, 0, height - 1) * width, np.clip(top + 1, 0, height - 1) * width
        corners = [y0 + x0, y0 + x1, y1 + x0, y1 + x1]
        for c in range(channels):
            plane = stack[i, ..., c].astype(np.int16).ravel()
            a, b, p, q = (plane.take(place) for place in corners)
            above = a + (b - a) * dx
            level = above + ((p + (q - p) * dx) - above) * dy
            level[outside] = 0
            out[i, ..., c] = truncate(level)
    return out


def model_input(stack, mean=None, std=None):
    """Float 0..1, channel first; with ``mean`` and ``std`` also normalised."""
    unit = stack.transpose(0, 3, 1, 2).astype(np.float32) / np.float32(255)
    if mean is None:
        return unit
    shape = (1, 3, 1, 1)
    return (unit - np.float32(mean).reshape(shape)) / np.float32(std).reshape(shape)


def jet_colours():
    """256 colours of the jet scale as RGB bytes."""
    at = np.linspace(0, 1, 256)
    levels = [np.interp(at, *corners) for corners in (JET_RED, JET_GREEN, JET_BLUE)]
    return truncate(np.stack(levels, axis=1) * 255)


def overlay(stack, masks, alpha):
    """Tint each picture with its mask; the colours span the mask's own largest class."""
    if masks.shape[1:3] != stack.shape[1:3]:
        masks = resize_nearest(masks, *stack.shape[1:3])
    largest = np.maximum(masks.max(axis=(1, 2, 3), keepdims=True), 1)
    place = np.minimum((masks / largest * 256).astype(int), 255)[..., 0]
    colours = jet_colours()
    return _by_channel(
        stack, lambda plane, c: (1 - alpha) * plane + alpha * colours[:, c].take(place)
    )
